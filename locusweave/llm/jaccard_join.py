"""Operator 2: exact Jaccard join of shingle sets in their metric space.

The distance 1 - J is a metric, and so is the size of the symmetric difference D. The join goes from coarse regions to fine
ones, and loses no link on the way:

1. Pivots, drawn from a bounded sample, create Voronoi regions, with an outside that lies at a constant distance from all. With d
   the least of a set's distances, the set goes to every region not further than d + 2 * (1 - t): by the triangle inequality
   one of them holds all its partners. Sets that link with a pivot itself are one component already and meet only others.
2. Within a region, sets meet in the rarest shingles that they share. How many sets hold a shingle is counted for a part of the
   hash space; of two linked sets each lacks few of the other's, so with the rarest first both have one that they share among
   their first few (see Counted). A set whose first few no other holds has no partner and goes no further. Sets
   that meet, directly or through others, form the finer regions.
3. Finer regions over a bound are divided again by pivots drawn from them and by slices of the hash space: there are more of these
   than the D of linked sets can touch, so that they agree in a whole slice, hence share a cell. Slices that hold little but
   common shingles make no cells, as enough others agree (see Slicer).
4. What is left is joined exactly, in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, table
from .graph import components
from .hashing import BASE, mix64, shingle_sets

WORDS = 3
#: Sets link when DEN * intersection >= NUM * union.
NUM, DEN = 90, 100
#: Sets and shingles of half a tile; regions over SPLIT sets (those of the largest pivot not counted) are divided again, LEVELS times in all.
SIDE, SIDE_SHINGLES, SPLIT, LEVELS = 512, 400_000, 1024, 2
#: Texts that pivots are drawn from and their most characters, pivots of a level, and the least distance between two of them.
SAMPLE, SAMPLE_CHARS, PIVOTS, APART = 4096, 8192, 256, 0.97
#: A set within this distance of a pivot may leave the outside; windows reach as far as WINDOW at most, beyond which pivots are not looked at.
WINDOW = 0.9
#: Shingles of so many different sets of the sample are common; slices beyond those D can touch, as a share of these.
COMMON, SPARE = 3, 0.5
#: The part of the hash space whose shingles are counted, as a multiple of the share of its shingles that a set linked with another may hold alone.
COUNTED = 2.0
#: Rows up to which a table of three longs is broadcast (under 50 MB as a hash relation).
SMALL = 300_000
#: Bytes of text whose cells one bucket of the cell shuffle holds.
BUCKET_BYTES = 6_000_000
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def rings(num: int, den: int, most: int) -> list[int]:
    """Lower bounds of the rings of set sizes, up to beyond `most`: a smaller partner lies in the same ring or the one below."""
    out = [1]
    while out[-1] <= most:
        out.append(-(-out[-1] * den * den // (num * num)))
    return [*out, -(-out[-1] * den * den // (num * num))]


class Slicer:
    def __init__(self, num: int = NUM, den: int = DEN, common: np.ndarray | None = None, level: int = 0):
        """`common` are sorted shingles that many sets hold: they decide which cells are kept, never whether a link is found."""
        self.num, self.den, self.bounds, self.level = num, den, rings(num, den, 1 << 10), level
        self.common = common if common is not None and len(common) else np.zeros(1, np.uint64)

    def cells(self, hashes: np.ndarray) -> np.ndarray:
        """The cells of a set (its sorted hashes): one for each slice kept of its ring, and of the one below if a partner may lie there.

        The smaller of two linked sets, of size n, has D <= n * (1 - t) / t. With `spare` more slices than that and one,
        linked sets agree in more than `spare` slices. Each set leaves out its `spare` slices of least rank, and the rank is a
        matter of a slice's content alone; so of the slices in which two linked sets agree both keep the one of highest rank.
        Slices with few shingles, common ones not counted, rank least.
        """
        n = len(hashes)
        while self.bounds[-2] <= n:
            self.bounds = rings(self.num, self.den, 2 * n)
        ring = int(np.searchsorted(self.bounds, n, "right")) - 1
        out = []
        with np.errstate(over="ignore"):
            turned = mix64(hashes + np.uint64((self.level * _ODD[1]) & (1 << 64) - 1)) if self.level else hashes
            order = np.argsort(turned) if self.level else slice(None)
            turned = turned[order]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(turned ^ np.uint64(0x5851F42D4C957F2D)))])
            at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
            own = np.concatenate([np.zeros(1, np.int64), np.cumsum((self.common[at] != hashes)[order])])
            for r in (ring, ring - 1):
                if r < 0 or (r < ring and (self.bounds[ring] - 1) * self.den < n * self.num):
                    continue
                differ = (self.den - self.num) * (self.bounds[r + 1] - 1) // self.num
                if differ == 0:
                    continue  # linked sets of this ring are equal
                spare = 1 + int(differ * SPARE)
                k = differ + 1 + spare
                slice_ = (turned >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)
                edge = np.searchsorted(slice_, np.arange(k + 1, dtype=np.uint64))
                value = mix64((sums[edge[1:]] - sums[edge[:-1]]) * np.uint64(BASE) + mix64(np.arange(k, dtype=np.uint64) + np.uint64(r << 32 | 1 << 60)))
                out.append(value[np.lexsort((value, np.diff(own[edge])))[spare:]])
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Counted:
    """The shingles by which sets meet: those of one part of the hash space, but for common ones, which are the same for all sets.

    Of n shingles a linked set holds at most n * (1 - t) alone. So if it has more than these in the part, one of them is shared,
    and in any order that is the same for all sets the first shared one stands among its first n * (1 - t) + 1. If two linked
    sets share none in the part, both have too few there; sets that have too few meet in all their shingles as well.
    """

    def __init__(self, num: int, den: int, common: np.ndarray):
        self.num, self.den = num, den
        self.common = common if len(common) else np.zeros(1, np.uint64)
        self.below = np.uint64(min((1 << 64) - 1, int(COUNTED * (den - num) / den * (1 << 64))))

    def alone(self, n: int) -> int:
        return n * (self.den - self.num) // self.den

    def of(self, hashes: np.ndarray) -> list[np.ndarray]:
        """The set's shingles in the part; if these are too few, also all."""
        some = hashes[: np.searchsorted(hashes, self.below)]
        at = np.minimum(np.searchsorted(self.common, some), len(self.common) - 1)
        some = some[self.common[at] != some]
        return [some] if len(some) > self.alone(len(hashes)) else [some, hashes]


def set_key(hashes: np.ndarray) -> int:
    """64 bits that stand for a whole set. Two of 10**9 different sets share them with a chance of 3 in 100."""
    with np.errstate(over="ignore"):
        return int(mix64(np.array([np.sum(mix64(hashes ^ np.uint64(0x2545F4914F6CDD1D))) + np.uint64(len(hashes))], np.uint64)).view(np.int64)[0])


@dataclass
class Pivots:
    """Pivot sets as an inverted index: which of them (ids) hold each shingle, their sizes and the keys of their sets."""

    shingles: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray
    keys: np.ndarray
    num: int
    den: int

    @staticmethod
    def of(sets: list[np.ndarray], num: int, den: int) -> Pivots:
        flat = np.concatenate([np.zeros(0, np.uint64), *sets])
        who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.lexsort((who, flat))
        shingles, first = np.unique(flat[order], return_index=True)
        return Pivots(shingles, np.append(first, len(flat)), who[order].astype(np.int32), np.array([len(s) for s in sets], np.int64), np.array([set_key(s) for s in sets], np.int64), num, den)

    def meet(self, hashes: np.ndarray) -> np.ndarray:
        """Shingles that the set shares with each pivot."""
        if not len(self.shingles):
            return np.zeros(len(self.sizes), np.int64)
        at = np.minimum(np.searchsorted(self.shingles, hashes), len(self.shingles) - 1)
        at = at[self.shingles[at] == hashes]
        many = self.offsets[at + 1] - self.offsets[at]
        where = np.repeat(self.offsets[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.bincount(self.ids[where], minlength=len(self.sizes))

    def regions(self, hashes: np.ndarray) -> tuple[np.ndarray, int | None]:
        """Regions that the set goes to (0 is the outside, k + 1 that of pivot k), and the key of a pivot that it links with."""
        if not len(self.sizes):
            return np.zeros(1, np.int64), None
        both = self.meet(hashes)
        union = self.sizes + len(hashes) - both
        far = np.concatenate([[WINDOW - 2 * (1 - self.num / self.den)], 1 - both / np.maximum(union, 1)])
        linked = np.flatnonzero(self.den * both >= self.num * union)
        core = int(self.keys[linked[np.argmin(far[1 + linked])]]) if len(linked) else None
        return np.flatnonzero(far <= far.min() + 2 * (1 - self.num / self.den) + 1e-9), core


def choose(sets: list[np.ndarray], num: int, den: int) -> tuple[Pivots, np.ndarray]:
    """Pivots of a sample of sets, and the sample's common shingles.

    Sets with many others near them come first; a pivot shares next to nothing with the pivots before it, so that a set
    lies near few of them. Any choice is right; this one puts large groups of near copies into regions of their own.
    """
    sets = [s for s in sets if len(s)]
    if not sets:
        return Pivots.of([], num, den), np.zeros(0, np.uint64)
    shingles, many = np.unique(np.concatenate(sets), return_counts=True)
    everything = Pivots.of(sets, num, den)
    near, meets = np.zeros(len(sets), np.int64), []
    for i, s in enumerate(sets):
        both = everything.meet(s)
        who = np.flatnonzero(both)
        near[i] = np.count_nonzero(2 * both[who] >= everything.sizes[who] + len(s) - both[who])
        meets.append((who, both[who]))
    chosen, barred = [], np.zeros(len(sets), bool)
    for i in np.argsort(-near, kind="stable").tolist():
        if not barred[i]:
            chosen.append(i)
            who, both = meets[i]
            barred[who[both > (1 - APART) * (everything.sizes[who] + len(sets[i]) - both)]] = True
            if len(chosen) == PIVOTS:
                break
    return Pivots.of([sets[i] for i in chosen], num, den), shingles[many >= COMMON]


def _sampled(texts: DataFrame, rows: int, words: int, num: int, den: int) -> tuple[Pivots, np.ndarray]:
    """choose() for about SAMPLE different texts, those first by hash, of bounded length: what the driver gets is bounded."""
    some = texts.where((F.pmod(F.xxhash64("text"), F.lit(max(1, rows // SAMPLE))) == 0) & (F.length("text") <= SAMPLE_CHARS))
    got = some.select("text").distinct().limit(2 * SAMPLE).toArrow()
    return choose(sorted(shingle_sets(got.column("text").to_pylist(), words), key=lambda s: s[:1].tolist()), num, den)


def places(key: int, region: int, regions: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the regions that lie in `region` at this level, and the nodes that stand for the set in them; a node's last bit is 0."""
    with np.errstate(over="ignore"):
        names = mix64(np.uint64(region & (1 << 64) - 1) + (regions.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD[0]) + np.uint64(level * _ODD[1] & (1 << 64) - 1))
        return names, (mix64(np.uint64(key & (1 << 64) - 1) ^ mix64(names)) & ~np.uint64(1)).view(np.int64)


SETS = "doc_id long, th long, region long, n_shingles long, key long, core long, nodes array<long>"


def _describe(words: int, pivots: Pivots, level: int):
    """Per row of (doc_id, th, region, text) its set's key and size, its nodes, and the pivot that it links with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, cores, nodes = [], [], [], []
            for region, s in zip(batch.column("region").to_pylist(), shingle_sets(batch.column("text").to_pylist(), words), strict=True):
                sizes.append(len(s))
                keys.append(set_key(s) if len(s) else None)
                found, core = pivots.regions(s) if len(s) else (np.zeros(0, np.int64), None)
                cores.append(core)
                nodes.append(places(keys[-1], region, found, level)[1].tolist() if len(s) else [])
            new = [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(cores, pa.int64()), pa.array(nodes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "th", "region")), *new], [c.split()[0] for c in SETS.split(", ")])

    return run


ENTRY = np.dtype([("cell", "<u4"), ("node", "<i8")])


def _chains(cells: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries come first in their cell (by node), and the pairs (node, first node of its cell) of all others."""
    order = np.lexsort((nodes, cells))
    cells, nodes = cells[order], nodes[order]
    new = np.concatenate([[True], cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, bool)
    heads = nodes[np.flatnonzero(new)][np.cumsum(new) - 1] if len(cells) else nodes
    other = nodes != heads
    pairs = np.stack([nodes[other], heads[other]], 1)
    return order[new], np.unique(pairs, axis=0) if len(pairs) else pairs


def _cells(words: int, num: int, den: int, common: np.ndarray, pivots: Pivots, level: int, buckets: int):
    """Entries (cell, node) by bucket, one per cell of a batch: what else shares it there is linked at once. Buckets under 0 hold such links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slicer = Slicer(num, den, common, level)
        for number, batch in enumerate(batches):
            seen, cells, nodes = set(), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for region, s in zip(batch.column("region").to_pylist(), shingle_sets(batch.column("text").to_pylist(), words), strict=True):
                if not len(s) or (key := set_key(s), region) in seen:
                    continue
                seen.add((key, region))
                own = slicer.cells(s)
                for name, node in zip(*places(key, region, pivots.regions(s)[0], level), strict=True):
                    cells.append(mix64(own ^ mix64(np.array([name], np.uint64))))
                    nodes.append(np.full(len(own), node))
            cells, nodes = np.concatenate(cells), np.concatenate(nodes)
            first, links = _chains(cells, nodes)
            cells, nodes = cells[first], nodes[first]  # by cell, hence by bucket
            bucket = ((cells >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            entries = np.empty(len(cells), ENTRY)
            entries["cell"], entries["node"] = (cells & np.uint64(0xFFFFFFFF)).astype(np.uint32), nodes
            begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
            blobs = [entries[a:b].tobytes() for a, b in zip(begin, np.append(begin[1:], len(bucket)), strict=True)] if len(bucket) else []
            names = bucket[begin].tolist()
            if len(links):
                names.append(-1 - int(mix64(links[:1, 0].view(np.uint64))[0] % np.uint64(buckets)))
                blobs.append(links.astype("<i8").tobytes())
            if blobs:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "entries"])

    return run


def _by_bucket(buckets: np.ndarray, entries: np.ndarray) -> tuple[list[int], list[bytes]]:
    """The buckets that occur, and the bytes of the entries of each."""
    order = np.argsort(buckets, kind="stable")
    buckets, entries = buckets[order], entries[order]
    begin = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(buckets) else np.zeros(0, np.int64)
    return buckets[begin].tolist(), [entries[a:b].tobytes() for a, b in zip(begin, np.append(begin[1:], len(buckets)), strict=True)] if len(buckets) else []


def _rows(buckets: list[int], blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    if blobs:
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "entries"])


#: A token is a shingle in a region; of its 64 bits the upper half is its bucket. What a node holds of all its shingles is counted apart, with 1 as the
#: node's last bit. `shift` is what its first few fall short of its tokens by.
NODE = np.dtype([("node", "<i8"), ("shift", "<i8")])
HELD = np.dtype([("node", "<i8"), ("token", "<u8"), ("sets", "<u4")])
RARE = np.dtype([("cell", "<u8"), ("node", "<i8")])
#: Buckets of tokens for one of nodes, or of tokens few enough to be dealt once more.
WIDER = 8


def _node_bucket(nodes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(nodes.view(np.uint64)) % np.uint64(max(1, buckets // WIDER))).astype(np.int64)


def _tokens(words: int, counted: Counted, pivots: Pivots, level: int, buckets: int):
    """Entries (token, node) by the token's bucket, and what is known of each node, under buckets less than 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, tokens, owners, nodes, shifts = set(), [np.zeros(0, np.uint64)], [], [], []
            for region, s in zip(batch.column("region").to_pylist(), shingle_sets(batch.column("text").to_pylist(), words), strict=True):
                if not len(s) or (key := set_key(s), region) in seen:
                    continue
                seen.add((key, region))
                where = list(zip(*places(key, region, pivots.regions(s)[0], level), strict=True))
                for k, part in enumerate(counted.of(s)):
                    for name, node in where:
                        own = mix64(part ^ mix64(np.array([name ^ np.uint64(k)], np.uint64)))
                        own = np.unique(((own >> np.uint64(32)) * np.uint64(buckets) & ~np.uint64(0xFFFFFFFF)) | (own & np.uint64(0xFFFFFFFF)))
                        tokens.append(own)
                        owners.append(len(own))
                        nodes.append(node | k)
                        shifts.append(len(own) - counted.alone(len(s)) - 1)
            nodes, tokens = np.array(nodes, np.int64), np.concatenate(tokens)
            entries = np.empty(len(tokens), ENTRY)
            entries["cell"], entries["node"] = (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.repeat(nodes, owners)
            known = np.empty(len(nodes), NODE)
            known["node"], known["shift"] = nodes, shifts
            yield from _rows(*map(list.__add__, _by_bucket((tokens >> np.uint64(32)).astype(np.int64), entries), _by_bucket(-1 - _node_bucket(nodes, buckets), known)))

    return run


def _count(buckets: int):
    """From rows sorted by bucket: the tokens that two nodes or more hold, with the number of these, by the node's bucket; what is known of nodes goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in _groups(batches, ["bucket"], ["entries"]):
            if bucket < 0:
                yield from _rows([2 * (-1 - bucket)], [b"".join(x for (x,) in rows)])
                continue
            entries = np.concatenate([np.frombuffer(x, ENTRY) for (x,) in rows])
            cells, nodes = entries["cell"], entries["node"]
            order = np.lexsort((nodes, cells))
            cells, nodes = cells[order], nodes[order]
            new = np.concatenate([[True], (cells[1:] != cells[:-1]) | (nodes[1:] != nodes[:-1])])
            cells, nodes = cells[new], nodes[new]
            begin = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
            sets = np.diff(np.append(begin, len(cells)))
            held = np.repeat(sets > 1, sets)
            out = np.empty(int(held.sum()), HELD)
            out["node"], out["token"], out["sets"] = nodes[held], np.uint64(bucket << 32) | cells[held].astype(np.uint64), np.repeat(sets, sets)[held]
            yield from _rows(*_by_bucket(2 * _node_bucket(out["node"], buckets) + 1, out))

    return run


def _rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries (token, node) of the tokens among each node's first few that other nodes hold too, the rarest first, by wider buckets of tokens.

    Rows come sorted by `half`, the bucket of nodes, with the two parts of a bucket one after the other: what is known of its nodes, and their tokens.
    """
    for _, rows in _groups(batches, ["half"], ["bucket", "entries"]):
        known = np.concatenate([np.zeros(0, NODE), *(np.frombuffer(x, NODE) for b, x in rows if b % 2 == 0)])
        held = np.concatenate([np.zeros(0, HELD), *(np.frombuffer(x, HELD) for b, x in rows if b % 2)])
        if not len(held):
            continue
        known = known[np.argsort(known["node"])]
        held = held[np.lexsort((held["token"], held["sets"], held["node"]))]
        begin = np.flatnonzero(np.concatenate([[True], held["node"][1:] != held["node"][:-1]]))
        many = np.diff(np.append(begin, len(held)))
        # tokens that no other node holds come first
        first = many - known["shift"][np.searchsorted(known["node"], held["node"][begin])]
        held = held[np.arange(len(held)) - np.repeat(begin, many) < np.repeat(first, many)]
        out = np.empty(len(held), RARE)
        out["cell"], out["node"] = held["token"], held["node"] & ~np.int64(1)
        yield from _rows(*_by_bucket((held["token"] >> np.uint64(32)).astype(np.int64) // WIDER, out))


def _meet_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of nodes that share a token, from rows sorted by bucket."""
    for _, rows in _groups(batches, ["bucket"], ["entries"]):
        entries = np.concatenate([np.frombuffer(x, RARE) for (x,) in rows])
        links = _chains(entries["cell"], entries["node"])[1]
        if len(links):
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], ["a", "b"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of nodes that share a cell, from rows sorted by bucket."""
    for (bucket,), rows in _groups(batches, ["bucket"], ["entries"]):
        if bucket < 0:
            links = np.concatenate([np.frombuffer(x, "<i8") for (x,) in rows]).reshape(-1, 2)
        else:
            entries = np.concatenate([np.frombuffer(x, ENTRY) for (x,) in rows])
            links = _chains(entries["cell"], entries["node"])[1]
        if len(links):
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], ["a", "b"])


def links_within(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect just what all links of these sets connect."""
    m = len(sets)
    root = list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))

    sizes = np.array([len(s) for s in sets])
    if m <= 24:
        for i in range(m):
            for j in range(i + 1, m):
                if den * min(sizes[i], sizes[j]) >= num * max(sizes[i], sizes[j]) and find(i) != find(j):
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if den * both >= num * (sizes[i] + sizes[j] - both):
                        join(i, j)
        return out
    flat, who = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    _, name, many = np.unique(flat, return_inverse=True, return_counts=True)
    shared = many[name] > 1
    name, who = name[shared], who[shared]
    order = np.argsort(name, kind="stable")
    name, who = name[order], who[order]
    column = np.cumsum(np.concatenate([[0], name[1:] != name[:-1]])) if len(name) else name
    both = np.zeros((m, m), np.float32)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        part = np.zeros((m, width), np.float32)
        part[who[a:b], column[a:b] - lo] = 1
        both += part @ part.T
    linked = den * both.astype(np.int64) >= num * (sizes[:, None] + sizes[None, :] - both.astype(np.int64))
    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        join(int(i), int(j))
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with the same keys, across batches."""
    now, rows = None, []
    for batch in batches:
        for key, row in zip(zip(*(batch.column(k).to_pylist() for k in keys), strict=True), zip(*(batch.column(k).to_pylist() for k in columns), strict=True), strict=True):
            if key != now:
                if rows:
                    yield now, rows
                now, rows = key, []
            rows.append(row)
    if rows:
        yield now, rows


def _join_tiles(words: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, ["region", "i", "j"], ["key", "text"]):
            sets = {}
            for (key, _), s in zip(rows, shingle_sets([t for _, t in rows], words), strict=True):
                if len(s) and set_key(s) == key:
                    sets[key] = s
            keys = list(sets)
            found = [(keys[i], keys[j]) for i, j in links_within(list(sets.values()), num, den)]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL else df


@dataclass
class _Join:
    words: int
    num: int
    den: int

    def sets(self, rows: DataFrame, pivots: Pivots, level: int) -> DataFrame:
        return materialise(rows.mapInArrow(_describe(self.words, pivots, level), SETS), "sets")

    def meetings(self, rows: DataFrame, pivots: Pivots, common: np.ndarray, level: int, buckets: int) -> DataFrame:
        """Links (a, b) of nodes that connect all that share a cell or, at the first level, a rare shingle."""
        entries, links = "bucket long, entries binary", "a long, b long"
        if level:
            cells = rows.mapInArrow(_cells(self.words, self.num, self.den, common, pivots, level, buckets), entries)
            return cells.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_meet, links)
        tokens = rows.mapInArrow(_tokens(self.words, Counted(self.num, self.den, common), pivots, level, buckets), entries)
        held = tokens.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count(buckets), entries).withColumn("half", F.shiftright("bucket", 1))
        rare = held.repartition("half").sortWithinPartitions("half", "bucket").mapInArrow(_rarest, entries)
        return rare.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_meet_in, links)

    def divide(self, rows: DataFrame, sets: DataFrame, pivots: Pivots, common: np.ndarray, level: int, buckets: int) -> DataFrame:
        """The finer regions of rows (region, text): region, key, core and size of each set that meets another."""
        regions = components(self.meetings(rows.select("region", "text"), pivots, common, level, buckets))
        nodes = sets.where("key IS NOT NULL").select("key", "core", "n_shingles", F.explode("nodes").alias("node")).dropDuplicates(["node"])
        # a set that several coarse regions hold has a node in each, and these often end in the same finer region
        members = regions.join(nodes, "node").groupBy(F.col("comp").alias("region"), "key").agg(F.min("core").alias("core"), F.min("n_shingles").alias("n_shingles"))
        return materialise(members, "members", regions.count())


def _tiles(members: DataFrame) -> DataFrame:
    """Deals the sets of each region to tiles (region, i, j) such that every two meet, but for two that link with the same pivot.

    In a region of many sets the few that link with one pivot are dealt like those that link with none: a part for each such group would
    multiply the copies of all others.
    """
    by = members.groupBy("region", "core").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    own = F.when((F.sum("n").over(W.partitionBy("region")) <= 2 * SIDE) | (F.col("n") >= SIDE), F.col("core"))
    few = by.withColumn("own", own).where("core IS NOT NULL AND own IS NULL").select(F.col("region").alias("of"), F.col("core").alias("few"))
    members = members.join(few, (F.col("region") == F.col("of")) & (F.col("core") == F.col("few")), "left").withColumn("core", F.when(F.col("few").isNull(), F.col("core"))).drop("of", "few")
    by = members.groupBy("region", "core").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    parts = F.greatest(F.ceil(F.col("n") / SIDE), F.ceil(F.col("weight") / SIDE_SHINGLES)).cast("int")
    whole, before = W.partitionBy("region"), W.partitionBy("region").orderBy("core").rowsBetween(W.unboundedPreceding, -1)
    by = by.withColumn("parts", parts).select(
        "region", F.col("core").alias("own"), "parts", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int").alias("low"), F.sum("parts").over(whole).cast("int").alias("all"),
        F.sum("n").over(whole).alias("sets"), F.sum("weight").over(whole).alias("shingles"), F.count("*").over(whole).alias("groups"),
    )
    by = by.where("groups > 1 OR own IS NULL").withColumnRenamed("region", "of")
    dealt = members.join(by, (F.col("region") == F.col("of")) & F.col("core").eqNullSafe(F.col("own")))
    mine = F.col("low") + F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    apart = lambda k: (k != mine) & (F.col("own").isNull() | (k < F.col("low")) | (k >= F.col("low") + F.col("parts")))
    pairs = F.transform(F.filter(F.sequence(F.lit(0), F.col("all") - 1), apart), lambda k: F.struct(F.least(k, mine).alias("i"), F.greatest(k, mine).alias("j")))
    small = (F.col("sets") <= 2 * SIDE) & (F.col("shingles") <= 2 * SIDE_SHINGLES)
    tiles = F.when(small | (F.col("all") == 1), one).otherwise(pairs)
    return dealt.select("region", "key", F.explode(tiles).alias("t")).select("region", "key", "t.i", "t.j")


def component_keys(docs: DataFrame, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Per row of (doc_id, th, text): doc_id, th, n_shingles and key; and the roots of all keys: key, comp, least doc_id and first (doc_id, th) of the key."""
    join = _Join(words, num, den)
    rows = docs.select("doc_id", "th", F.lit(0).cast("long").alias("region"), "text")
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    buckets = lambda size: max(1, min(1 << 20, (size or 0) // BUCKET_BYTES))
    pivots, common = _sampled(rows, n, words, num, den)
    sets = join.sets(rows, pivots, 0)
    members = join.divide(rows, sets, pivots, common, 0, buckets(size))
    cores = [sets.where("core IS NOT NULL").select(F.col("key").alias("a"), F.col("core").alias("b"))]
    first = materialise(sets.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "th")).alias("row")), "keys", n)

    def texts_of(keys: DataFrame) -> DataFrame:
        """key and text of each set; a set's text is that of one row that has it, whether the row has an id or not."""
        wanted = materialise(keys.select("key").distinct().join(first, "key").select("key", F.col("row.doc_id").alias("of"), F.col("row.th").alias("hash")), "wanted")
        some = _maybe_broadcast(wanted)
        found = materialise(docs.join(some, (docs["th"] == some["hash"]) & docs["doc_id"].eqNullSafe(some["of"])).select("key", "text"), "texts")
        return found.dropDuplicates(["key"]) if found.count() > wanted.count() else found

    done = None
    for level in range(1, LEVELS):
        # sets that link with the region's most common pivot need not meet each other, so they do not make a region too big
        by = members.groupBy("region", "core").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
        largest = F.coalesce(F.max(F.when(F.col("core").isNotNull(), F.col("n"))), F.lit(0))
        by = by.groupBy("region").agg(F.sum("n").alias("size"), F.sum("shingles").alias("shingles"), largest.alias("largest"))
        big = materialise(by.where(F.col("size") - F.col("largest") > SPLIT), "big-regions")
        n, size = big.agg(F.sum("size"), F.sum("shingles")).first()
        if not n:
            break
        inside = members.join(_maybe_broadcast(big.select("region")), "region", "left_semi")
        rest = members.join(_maybe_broadcast(big.select("region")), "region", "left_anti")
        none = F.lit(None).cast("long")
        rows = materialise(inside.select("region", "key").join(texts_of(inside), "key").select(none.alias("doc_id"), none.alias("th"), "region", "text"), "inside")
        pivots, common = _sampled(rows, n, words, num, den)
        finer = join.sets(rows, pivots, level)
        cores.append(finer.where("core IS NOT NULL").select(F.col("key").alias("a"), F.col("core").alias("b")))
        done = rest if done is None else done.unionByName(rest)
        members = join.divide(rows, finer, pivots, common, level, buckets(8 * size))
    members = members if done is None else materialise(done.unionByName(members), "members")
    dealt = materialise(_tiles(members), "tiles")
    tiled = dealt.join(texts_of(dealt), "key").repartition("region", "i", "j").sortWithinPartitions("region", "i", "j", "key")
    links = tiled.mapInArrow(_join_tiles(words, num, den), "a long, b long")
    for core in cores:
        links = links.unionByName(core.where("a <> b").distinct())
    linked = components(links)
    roots = materialise(first.join(linked.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key")), "roots")
    return sets.select("doc_id", "th", "n_shingles", "key"), roots


def hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("th", F.xxhash64("text"))


def near_components(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per row of (doc_id, text, ...): doc_id, n_shingles and component_id, the smallest doc_id that links lead to.

    A text without words (null, empty, white space) has no shingles and is linked with nothing. Equal sets are one node, so
    thousands of copies cost as much as one. Rows that repeat a doc_id keep a result each. A row without a doc_id links like
    any other, and others through it; component_id is null only if no row of the component has an id. An empty table gives an
    empty result. Long texts are hashed in pieces, at some 40 bytes of memory a word. Other columns are not read.
    Sets are compared by 64-bit hashes of their shingles and named by 64-bit hashes.
    """
    rows, roots = component_keys(hashed(docs.select("doc_id", "text")), words, num, den)
    smallest = roots.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    by_key = roots.select("key", "comp").join(smallest, "comp").select("key", "component_id")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(by_key, "key", "left").select("doc_id", "n_shingles", own.alias("component_id"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles FROM w
), u AS MATERIALIZED (
  SELECT r, hash(s) AS h, s FROM (SELECT r, unnest(shingles) AS s FROM s)
), shared AS (
  SELECT a.r AS x, b.r AS y, count(*) AS n FROM u a JOIN u b ON a.h = b.h AND a.s = b.s AND a.r < b.r GROUP BY a.r, b.r
), link AS MATERIALIZED (
  SELECT x, y FROM shared JOIN s a ON a.r = x JOIN s b ON b.r = y WHERE 100 * n >= 90 * (len(a.shingles) + len(b.shingles) - n)
), edge AS (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
  SELECT r AS x, r AS y FROM s UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM s JOIN reach ON reach.x = s.r JOIN s o ON o.r = reach.y GROUP BY s.r, s.doc_id, s.shingles
"""
