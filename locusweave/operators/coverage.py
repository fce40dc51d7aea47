"""Shared bases of regions and intervals by running sums along the chromosome, without a pair of the two.

C(x) is the number of bases that intervals of a category have at or before x, an interval that lies over another counting again:
starts at or before x give x + 1 - start each, stops before x take x - stop each back. The bases of a region [a, b] are
C(b) - C(a - 1), whatever lies in it; so the cost follows the ends of regions and intervals, not how often these meet. The intervals
that meet the region are those that start at or before b, less those that stop before a.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.operators.union import stretch_number
from locusweave.sources.store import stored

#: Base pairs of a stretch, whose ends one task holds; and rows of regions that one task reads for a stretch before it is split.
STRETCH, PART = 1 << 20, 50_000

#: What a row of the sorted stream of a stretch is: what reaches in from before, ends of an interval, or points of a region row.
_BEFORE, _ENDS, _POINTS = range(3)


def _ends_by_stretch(intervals: DataFrame, stretch: int) -> DataFrame:
    """A row for each stretch that holds a start or a stop; both, where they are in one."""
    rows = intervals.withColumn("__s", stretch_number("start", stretch)).withColumn("__e", stretch_number("stop", stretch))
    end = lambda n, s, e: F.struct(n.alias("stretch"), s.cast("bigint").alias("s"), e.cast("bigint").alias("e"))
    none = F.lit(None)
    both = F.when(F.col("__s") == F.col("__e"), F.array(end(F.col("__s"), F.col("start"), F.col("stop")))).otherwise(
        F.array(end(F.col("__s"), F.col("start"), none), end(F.col("__e"), none, F.col("stop")))
    )
    return rows.select("chrom", "names", F.explode(both).alias("x")).select("chrom", "names", "x.stretch", "x.s", "x.e")


def _reaching_in(ends: DataFrame, wanted: DataFrame, stretch: int) -> DataFrame:
    """Per (chrom, stretch, name) of wanted stretches: the intervals open at its first base and the bases covered before it.

    Ends are counted and added up per stretch first, as distances from its first base. What one task sees of a chromosome is a row
    per stretch and name.
    """
    inside = lambda c: F.sum(F.col(c) - F.col("stretch") * F.lit(stretch))
    named = ends.select("chrom", F.explode("names").alias("name"), "stretch", "s", "e")
    sums = named.groupBy("chrom", "name", "stretch").agg(F.count("s").alias("n_s"), F.count("e").alias("n_e"), inside("s").alias("sum_s"), inside("e").alias("sum_e"))
    return _along(sums, wanted, stretch)


def _along(sums: DataFrame, wanted: DataFrame, stretch: int) -> DataFrame:
    """Of the numbers and sums of ends per stretch and name: what _reaching_in gives, and as `started` the intervals that start before."""
    rows = sums.unionByName(wanted.select("chrom", "stretch"), allowMissingColumns=True)

    def along(table: pa.Table) -> pa.Table:
        chrom, names = table.column("chrom")[0].as_py(), np.array(table.column("name").to_pylist(), object)
        at, *sums = (table.column(c).fill_null(0).to_numpy() for c in ("stretch", "n_s", "n_e", "sum_s", "sum_e"))
        asked = names == None  # noqa: E711
        to, out = np.unique(at[asked]), {"stretch": [], "name": [], "s": [], "e": [], "started": []}
        with np.errstate(over="ignore"):  # sums may pass 64 bits and come back; the results do not
            for name in sorted(set(names[~asked])):
                mine = np.flatnonzero(names == name)
                mine = mine[np.argsort(at[mine], kind="stable")]
                n_s, n_e, sum_s, sum_e = (np.append(0, np.cumsum(c[mine])) for c in sums)
                far = [np.append(0, np.cumsum(c[mine] * (at[mine] * stretch))) for c in sums[:2]]
                k, first = np.searchsorted(at[mine], to), to * stretch
                covered = (n_s[k] * first - far[0][k] - sum_s[k]) - (n_e[k] * (first - 1) - far[1][k] - sum_e[k])
                out["stretch"].append(to)
                out["name"] += [name] * len(to)
                out["s"].append(n_s[k] - n_e[k])
                out["e"].append(covered)
                out["started"].append(n_s[k])
        joined = {c: pa.array(np.concatenate(out[c]) if out[c] else np.zeros(0, np.int64), pa.int64()) for c in ("stretch", "s", "e", "started")}
        return pa.table({"chrom": pa.array([chrom] * len(out["name"]), pa.string()), "stretch": joined["stretch"], "name": pa.array(out["name"], pa.string()), **{c: joined[c] for c in ("s", "e", "started")}})

    return rows.groupBy("chrom").applyInArrow(along, "chrom string, stretch bigint, name string, s bigint, e bigint, started bigint")


class _Stretch:
    """The ends of one stretch, by name, as they come; then sorted with their running sums."""

    def __init__(self, first: int, stretch: int):
        self.first, self.span = first, stretch + 1
        self.names, self.open, self.covered, self.parts, self.ready = [], [], [], [], False

    def sort(self) -> None:
        self.ready = True
        self.number = {name: k for k, name in enumerate(self.names)}
        self.before = np.array(self.open, np.int64), np.array(self.covered, np.int64)
        self.sides = []
        for side in range(2):
            keys = [np.zeros(0, np.int64)]
            for names, *ends in self.parts:
                # names: (offsets, labels); an interval counts for each of its names
                offsets, labels = names
                held = ends[side][1]
                n = np.diff(offsets)
                code = np.array([self.number[x] for x in labels.dictionary.to_pylist()], np.int64)[labels.indices.to_numpy(zero_copy_only=False)]
                here = np.repeat(held, n)
                keys.append(code[here] * self.span + (np.repeat(ends[side][0], n)[here] - self.first))
            keys = np.sort(np.concatenate(keys))
            sums = np.concatenate([[0], np.cumsum(keys % self.span)])
            begin = np.searchsorted(keys, np.arange(len(self.names)) * self.span)
            self.sides.append((keys, sums, begin))
        self.parts = []

    def covered_at(self, x: np.ndarray) -> np.ndarray:
        """C of each point for each name."""
        rel = x - self.first
        at = np.arange(len(self.names))[None, :] * self.span + rel[:, None]
        count, total = [], []
        for (keys, sums, begin), side in zip(self.sides, ("right", "left"), strict=True):
            k = np.searchsorted(keys, at.ravel(), side).reshape(at.shape)
            count.append(k - begin)
            total.append(sums[k] - sums[begin])
        is_open, covered = self.before
        rel = rel[:, None]
        return covered + is_open * (rel + 1) + count[0] * (rel + 1) - total[0] - (count[1] * rel - total[1])


def _dictionary(labels: pa.Array) -> pa.DictionaryArray:
    return labels if isinstance(labels, pa.DictionaryArray) else labels.dictionary_encode()


def _scan(stretch: int, keys: Sequence[str], cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            chrom, number, part, kind = (batch.column(c) for c in ("chrom", "stretch", "part", "kind"))
            number, part, kind = (c.to_numpy() for c in (number, part, kind))
            code = _dictionary(chrom).indices.to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((np.diff(code) != 0) | (np.diff(number) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                if a == b:
                    continue
                if (where := (chrom[a].as_py(), int(number[a]), int(part[a]))) != at:
                    at, held = where, _Stretch(int(number[a]) * stretch, stretch)
                rows = batch.slice(a, b - a)
                if kind[a] == _BEFORE:
                    held.names += [x[0] for x in rows.column("names").to_pylist()]
                    held.open += rows.column("s").to_pylist()
                    held.covered += rows.column("e").to_pylist()
                elif kind[a] == _ENDS:
                    names = rows.column("names")
                    offsets = names.offsets.to_numpy()
                    held.parts.append(((offsets - offsets[0], _dictionary(names.flatten())), *((rows.column(c).fill_null(0).to_numpy(), rows.column(c).is_valid().to_numpy(zero_copy_only=False)) for c in "se")))
                else:
                    if not held.ready:
                        held.sort()
                    if held.names:
                        yield from _bases(held, rows, keys, cells)

    return run


def _bases(held: _Stretch, rows: pa.RecordBatch, keys: Sequence[str], cells: int) -> Iterator[pa.RecordBatch]:
    """A row per region row and name: what this stretch adds to the bases of each cell."""
    m = len(held.names)
    for first in range(0, rows.num_rows, 2048):
        some = rows.slice(first, 2048)
        n, points = some.num_rows, some.column("points")
        size = np.diff(points.offsets.to_numpy())
        flat = points.flatten()
        owner = np.repeat(np.arange(n), size)
        covered = held.covered_at(flat.field("x").to_numpy())
        gains = flat.field("gains")
        g_size, gains = np.diff(gains.offsets.to_numpy()), gains.flatten().to_numpy()
        point = np.repeat(np.arange(len(owner)), g_size)
        cell, sign = np.abs(gains) - 1, np.sign(gains)
        out = np.zeros((n, m, cells), np.int64)
        for s in (1, -1):
            # a row has a cell's high and its low end once at most, so that nothing is added twice in one statement
            mine = sign == s
            out[owner[point[mine]], :, cell[mine]] += s * covered[point[mine]]
        who = pa.array(np.repeat(np.arange(n), m))
        columns = {c: some.column(c).take(who) for c in keys}
        columns["name"] = pa.array(held.names * n)
        columns["bases"] = pa.ListArray.from_arrays(pa.array(np.arange(n * m + 1, dtype=np.int32) * cells), pa.array(out.ravel()))
        yield pa.RecordBatch.from_pydict(columns)


def region_bases(rows: DataFrame, keys: Sequence[str], regions: Sequence[tuple[str, str]], intervals: DataFrame, names: Column, stretch: int = STRETCH, part: int = PART) -> DataFrame:
    """Per row and name of its chromosome: `keys`, `name`, and the shared bases of each region as bases_0, bases_1, ...

    `rows` have `chrom` (one of the keys), `regions` are (first, last) position in SQL over them, `intervals` have chrom, start
    and stop, and `names` is an array of strings over them, the categories that an interval counts for. Rows and intervals with
    a null chrom or coordinate are left out, and intervals that end before they start; a region that ends before it starts
    has no bases. Equal rows are added up. A chromosome without intervals has no names, hence no rows.

    The ends of a region are points, each in the one stretch of the chromosome that holds it, as are the starts and stops of
    intervals; stretches without points are not read. Each is one sorted stream: what reaches in, ends of intervals, then the
    region rows, which pass by a batch at a time. A stretch with over `part` region rows is split by a measured count.
    `intervals` are read twice: give a stored table. Coordinates are any 64-bit numbers; intervals and regions of any length cost the same.
    """
    held = intervals.dropna(subset=["chrom", "start", "stop"]).where("stop >= start").select("chrom", "start", "stop", names.alias("names"))
    ends = _ends_by_stretch(held, stretch)
    # equal positions, such as the gene's own ends, are one point
    gains: dict[str, list[int]] = {}
    for k, (low, high) in enumerate(regions):
        gains.setdefault(high, []).append(k + 1)
        gains.setdefault(f"{low} - 1", []).append(-(k + 1))
    every = F.expr("array(" + ", ".join(f"struct(bigint({x}) AS x, array({', '.join(map(str, g))}) AS gains)" for x, g in gains.items()) + ")")
    number = lambda x: x - F.pmod(x, F.lit(stretch))
    kept = rows.where(F.col("chrom").isNotNull()).select(*keys, F.filter(every, lambda p: p["x"].isNotNull()).alias("points"))
    floors = F.array_distinct(F.transform("points", lambda p: number(p["x"])))
    dealt = kept.select(*keys, "points", F.explode(floors).alias("__floor"))
    mine = F.filter("points", lambda p: number(p["x"]) == F.col("__floor"))
    dealt = dealt.select(*keys, F.expr(f"__floor div {stretch}").alias("stretch"), mine.alias("points"))
    wanted = dealt.groupBy("chrom", "stretch").agg(F.ceil(F.count("*") / F.lit(part)).cast("int").alias("parts"))
    before = _reaching_in(ends, wanted, stretch).select("chrom", "stretch", F.lit(_BEFORE).alias("kind"), F.array("name").alias("names"), "s", "e")
    side = before.unionByName(ends.select("chrom", "stretch", F.lit(_ENDS).alias("kind"), "names", "s", "e"))
    side = side.join(wanted, ["chrom", "stretch"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    dealt = dealt.join(wanted, ["chrom", "stretch"]).withColumn("part", F.pmod(F.xxhash64(*keys), F.col("parts")).cast("int")).drop("parts").withColumn("kind", F.lit(_POINTS))
    stream = side.unionByName(dealt, allowMissingColumns=True).repartition("chrom", "stretch", "part").sortWithinPartitions("chrom", "stretch", "part", "kind")
    kinds = dict(rows.select(*keys).dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "name string", "bases array<bigint>"])
    found = stream.mapInArrow(_scan(stretch, keys, len(regions)), schema)
    return found.groupBy(*keys, "name").agg(*(F.expr(f"greatest(sum(bases[{k}]), 0) AS bases_{k}") for k in range(len(regions))))


#: Base pairs of a stretch for region_counts, as a power of two, and ends that are packed at once.
BITS, PACKED = 18, 200_000


def _packed(bits: int):
    """Rows of (chrom, start, stop): per chromosome and stretch the starts and the stops in it, as sorted distances from its first base, and their sums."""

    def grouped(codes: np.ndarray, at: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        number = at >> bits
        low = int(number.min())
        wide, names = int(number.max()) - low + 1, None
        if wide * (int(codes.max()) + 1) >= 1 << (62 - bits):
            names, number = np.unique(number, return_inverse=True)
            wide = len(names)
        else:
            number = number - low
        keys = np.sort(((codes * wide + number) << bits) | (at & ((1 << bits) - 1)))
        group, keys = keys >> bits, (keys & ((1 << bits) - 1)).astype("<i4")
        begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        of = lambda g: (g // wide, int(names[g % wide]) if names is not None else low + g % wide)
        return {of(int(group[a])): keys[a:b] for a, b in zip(begin, np.append(begin[1:], len(group)), strict=True)}

    def pack(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], chroms: list[str]) -> pa.RecordBatch:
        codes, starts, stops = map(np.concatenate, zip(*held, strict=True))
        s, e = grouped(codes, starts), grouped(codes, stops)
        places = list(s.keys() | e.keys())
        none = np.zeros(0, "<i4")
        columns = {"chrom": pa.array([chroms[c] for c, _ in places], pa.string()), "stretch": pa.array([k for _, k in places], pa.int64())}
        for side, ends in (("s", s), ("e", e)):
            ends = [ends.get(p, none) for p in places]
            columns[f"n_{side}"] = pa.array([len(x) for x in ends], pa.int64())
            columns[f"sum_{side}"] = pa.array([int(x.sum(dtype=np.int64)) for x in ends], pa.int64())
            columns[side] = pa.array([x.tobytes() for x in ends], pa.binary())
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, chroms, held, size = {}, [], [], 0
        for batch in batches:
            names = _dictionary(batch.column("chrom"))
            for x in names.dictionary.to_pylist():
                if x not in number:
                    number[x] = len(chroms)
                    chroms.append(x)
            code = np.array([number[x] for x in names.dictionary.to_pylist()], np.int64)[names.indices.to_numpy(zero_copy_only=False)]
            held.append((code, batch.column("start").to_numpy(), batch.column("stop").to_numpy()))
            size += batch.num_rows
            if size >= PACKED:
                yield pack(held, chroms)
                number, chroms, held, size = {}, [], [], 0
        if size:
            yield pack(held, chroms)

    return run


class _Side:
    """Distances of ends from the first base of a stretch, with the running numbers and sums of these."""

    def __init__(self, bits: int):
        self.bits, self.parts, self.size, self.counts = bits, [], 0, None

    def add(self, blob: bytes) -> None:
        self.parts.append(np.frombuffer(blob, "<i4"))
        self.size += len(self.parts[-1])
        if self.size > 1 << self.bits:  # more ends than positions: only how many lie at each is kept
            self.counts = self._counted() + (0 if self.counts is None else self.counts)
            self.parts, self.size = [], 0

    def _counted(self) -> np.ndarray:
        return np.bincount(np.concatenate([np.zeros(0, "<i4"), *self.parts]), minlength=1 << self.bits)

    def ready(self) -> None:
        if self.counts is not None:
            self.at, many = None, self.counts + self._counted()
            where = np.arange(1 << self.bits)
        else:
            self.at = where = np.sort(np.concatenate([np.zeros(0, "<i4"), *self.parts]))
            many = np.ones(len(where), np.int64)
        self.number, self.total = (np.append(0, np.cumsum(x)) for x in (many, many * where))
        self.parts = []

    def before(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and sum of the ends at or before each distance."""
        k = x + 1 if self.at is None else np.searchsorted(self.at, x, "right")
        return self.number[k], self.total[k]


def _scan_counts(bits: int, keys: Sequence[str], cells: Sequence[tuple[int, int]]):
    """As _scan, over ends packed by stretch: per region row what this stretch adds to the intervals (n) and the bases of each cell.

    `cells` are the numbers of the points b and a - 1 of each.
    """

    def found(rows: pa.RecordBatch, number: int, reach: tuple[int, int, int], sides: tuple[_Side, _Side]) -> pa.RecordBatch:
        points = rows.column("points").flatten()
        known, x = points.is_valid().to_numpy(zero_copy_only=False), points.fill_null(0).to_numpy()
        mine = known & ((x >> bits) == number)
        rel = np.where(mine, x - (number << bits), 0)
        is_open, covered, started = reach
        (n_s, sum_s), (n_e, sum_e) = (side.before(rel) for side in sides)
        starts, stops = started + n_s, started - is_open + n_e
        covered = covered + is_open * (rel + 1) + n_s * (rel + 1) - sum_s - (n_e * rel - sum_e)
        starts, stops, covered = (np.where(mine, y, 0).reshape(rows.num_rows, -1) for y in (starts, stops, covered))
        known, x = known.reshape(starts.shape), x.reshape(starts.shape)
        out = np.zeros((2, rows.num_rows, len(cells)), np.int64)
        for k, (high, low) in enumerate(cells):
            # a region that ends before it starts has nothing
            ok = known[:, high] & known[:, low] & (x[:, high] > x[:, low])
            out[0, ok, k] = starts[ok, high] - stops[ok, low]
            out[1, ok, k] = covered[ok, high] - covered[ok, low]
        offsets = pa.array(np.arange(rows.num_rows + 1, dtype=np.int32) * len(cells))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(y.ravel())) for y in out]
        return pa.RecordBatch.from_arrays([*(rows.column(c) for c in keys), *lists], [*keys, "n", "bases"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reach, sides, ready = None, (0, 0, 0), None, False
        for batch in batches:
            chrom, number, part, kind = (batch.column(c) for c in ("chrom", "stretch", "part", "kind"))
            number, part, kind = (c.to_numpy() for c in (number, part, kind))
            code = _dictionary(chrom).indices.to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((np.diff(code) != 0) | (np.diff(number) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                if a == b:
                    continue
                if (where := (chrom[a].as_py(), int(number[a]), int(part[a]))) != at:
                    at, reach, sides, ready = where, (0, 0, 0), (_Side(bits), _Side(bits)), False
                rows = batch.slice(a, b - a)
                if kind[a] == _BEFORE:
                    reach = tuple(rows.column(c)[0].as_py() for c in ("open", "covered", "started"))
                elif kind[a] == _ENDS:
                    for side, c in zip(sides, "se", strict=True):
                        for blob in rows.column(c).to_pylist():
                            side.add(blob)
                else:
                    if not ready:
                        ready = True
                        for side in sides:
                            side.ready()
                    for first in range(0, rows.num_rows, 4096):
                        yield found(rows.slice(first, 4096), at[1], reach, sides)

    return run


def region_counts(rows: DataFrame, keys: Sequence[str], regions: Sequence[tuple[str, str]], intervals: DataFrame, bits: int = BITS, part: int = PART) -> DataFrame:
    """Per `keys` of the rows (chrom is one of them) the intervals that each region meets, as n_0, n_1, ..., and the bases shared with them, as bases_0, ...

    `regions` and what is left out are as in region_bases. Every interval is read once, packed into the few bytes of its two ends, and stored;
    a stretch with more ends than positions is held as one number a position, so memory does not follow how many intervals lie over another.
    """
    stretch = 1 << bits
    held = intervals.dropna(subset=["chrom", "start", "stop"]).where("stop >= start").select("chrom", F.col("start").cast("bigint"), F.col("stop").cast("bigint"))
    blobs = "chrom string, stretch bigint, n_s bigint, sum_s bigint, s binary, n_e bigint, sum_e bigint, e binary"
    packed = stored(held.mapInArrow(_packed(bits), blobs), "packed-ends")
    # equal positions, such as the gene's own end, are one point
    number: dict[str, int] = {}
    cells = [tuple(number.setdefault(x, len(number)) for x in (high, f"{low} - 1")) for low, high in regions]
    points = F.expr("array(" + ", ".join(f"bigint({x})" for x in number) + ")")
    kept = rows.where(F.col("chrom").isNotNull()).select(*keys, points.alias("points"))
    touched = F.array_distinct(F.transform(F.array_compact("points"), lambda x: F.shiftright(x, bits)))
    dealt = kept.select(*keys, "points", F.explode(touched).alias("stretch"))
    wanted = dealt.groupBy("chrom", "stretch").agg(F.ceil(F.count("*") / F.lit(part)).cast("int").alias("parts"))
    sums = packed.groupBy("chrom", "stretch").agg(F.lit("").alias("name"), *(F.sum(c).alias(c) for c in ("n_s", "n_e", "sum_s", "sum_e")))
    before = _along(sums, wanted, stretch).select("chrom", "stretch", F.lit(_BEFORE).alias("kind"), F.col("s").alias("open"), F.col("e").alias("covered"), "started")
    side = before.unionByName(packed.select("chrom", "stretch", F.lit(_ENDS).alias("kind"), "s", "e"), allowMissingColumns=True)
    dealt = dealt.withColumn("kind", F.lit(_POINTS))
    full = F.broadcast(wanted.where("parts > 1"))  # one row for so many rows of regions
    side = side.join(full, ["chrom", "stretch"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    dealt = dealt.join(full, ["chrom", "stretch"], "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64(*keys), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    stream = side.unionByName(dealt, allowMissingColumns=True).repartition("chrom", "stretch", "part").sortWithinPartitions("chrom", "stretch", "part", "kind")
    kinds = dict(rows.select(*keys).dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "n array<bigint>", "bases array<bigint>"])
    found = stream.mapInArrow(_scan_counts(bits, keys, cells), schema)
    return found.groupBy(*keys).agg(*(F.expr(e) for k in range(len(regions)) for e in (f"sum(n[{k}]) AS n_{k}", f"sum(bases[{k}]) AS bases_{k}")))
