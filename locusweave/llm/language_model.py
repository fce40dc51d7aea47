"""Operator 9: a gated recurrent language model in numpy, with a softmax factored by groups and classes, beside a smoothed unigram base."""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table
from .hashing import slabs, word_hashes

SMOOTH = 0.1
#: Words whose counts every task gets (12 bytes each); rarer ones are looked up by a join.
HEAD = 500_000
#: Words of the recurrent model, with the end and one for all others: bands of falling frequency, of (classes, words a class).
BANDS = ((32, 32), (48, 64), (112, 256))
#: Classes of a group: the softmax is one of groups, one of a group's classes and one of a class's words.
GROUP = 16
END, OTHER = 0, 1
EMBED, HIDDEN = 24, 24
#: Training: least and most lanes that run side by side, steps that gradients go back, one of so many documents in the first
#: round, rates of the tables (Adagrad) and of the rest (Adam), bounds of gradients and output weights; training tokens of a
#: shard, and shards of a small corpus if each gets its least.
LEAST_LANES, LANES, STEPS, ONE_OF, TABLE_RATE, RATE, CLIP, LARGEST = 32, 512, 16, 16, 0.12, 6e-3, 1.0, 2.5
SHARD_TOKENS, SHARDS, SHARD_LEAST = 4_000_000, 8, 250_000
#: Scoring: most lanes, steps whose ids are laid out at once, rows whose softmax is taken together, and bytes of ids in the lanes,
#: enough that other documents stand beside the longest ones.
WIDE, WINDOW, TOGETHER, BESIDE = 1024, 32, 1 << 16, 1 << 24
#: Rows whose softmax is taken at once, so that it stays in a core's cache; up to so many cells, classes of a group are one product.
ROWS_AT_ONCE, CELLS_AT_ONCE = 1024, 1 << 17
#: Rows of a table that are updated at once, for the same reason.
TABLE_ROWS = 1024
#: Rows, and bytes or characters of text, that are worked on at once, which bounds a worker's memory; one longer text stands alone.
ROWS, SIZE = 2500, 1 << 24
#: Models that one task adds up, and the steps of one that weights are added up in: as whole numbers, in whatever order they come.
FAN_IN, UNIT = 16, 1 << 20
SEED = 90
FIRST = np.cumsum([0, *(words for classes, words in BANDS for _ in range(classes))])  # where each class begins
CLASSES, VOCABULARY = len(FIRST) - 1, int(FIRST[-1])
CLASS_OF = np.repeat(np.arange(CLASSES), np.diff(FIRST)).astype(np.int16)
GROUP_FIRST = np.append(np.arange(0, CLASSES, GROUP), CLASSES)  # where each group's classes begin
GROUPS = len(GROUP_FIRST) - 1
#: Runs of classes of a band, of equally many words, that can be worked on as one: (first class, end, words a class).
RUNS = [(at, min(at + GROUP, end), words) for end, (classes, words) in zip(np.cumsum([c for c, _ in BANDS]).tolist(), BANDS, strict=True) for at in range(end - classes, end, GROUP)]
ONES = np.ones(max(GROUPS, GROUP, *(words for _, words in BANDS)), np.float32)


def portions(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, size = 0, 0
        for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            if i > at and (i - at == ROWS or size + n > SIZE):
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += n
        if at < batch.num_rows:
            yield batch.slice(at)


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


# ---- counts -------------------------------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches):
        parts = [word_hashes(run)[0] for _, run in slabs(batch.column("text").to_pylist())]
        words, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])


@dataclass
class Head:
    """Counts of the most frequent words (sorted by hash), their model ids, and what the whole corpus adds up to."""

    words: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    tokens: int
    distinct: int
    ends: int
    unigram: np.ndarray  # of the model's words

    def base(self, n):
        return np.log10((n + SMOOTH) / (self.tokens + SMOOTH * (self.distinct + 1)))

    @property
    def mass(self) -> float:
        """Base probability of all that the model calls OTHER."""
        return float(self.unigram[OTHER])

    def __post_init__(self) -> None:
        """Where the words of each stretch of hashes begin; stretches are so short that few hold two words."""
        self.bits = max(1, len(self.words).bit_length() + 1)
        self.begin = np.searchsorted(self.words, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)
        self.padded = np.append(self.words, np.zeros(1, np.uint64))

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Per token the number of its word, or of words in all where it is none of them."""
        at, none = self.begin[hashes >> np.uint64(64 - self.bits)], len(self.words)
        left = np.flatnonzero((self.padded[at] != hashes) & (at < none))
        at[left[self.padded[at[left]] > hashes[left]]] = none
        left = left[at[left] < none]
        while len(left):  # the word at hand is smaller: go on to the next
            at[left] += 1
            left = left[(at[left] < none) & (self.padded[at[left]] != hashes[left])]
            past = self.padded[at[left]] > hashes[left]
            at[left[past]] = none
            left = left[~past]
        return at

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: its model id, its count (0 where not found), and whether it was found."""
        k = self.index(hashes)
        return np.append(self.ids, np.int32(OTHER))[k], np.append(self.counts, 0)[k], k < len(self.words)


def head_of(counts: DataFrame, ends: int) -> Head:
    """The words that stand over the lowest of 16 steps per doubling of the count above which at most HEAD words lie."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    steps = sorted(((r["step"], r["words"], r["tokens"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect()), reverse=True)
    least, room = None, HEAD
    for s, words, _ in steps:
        room -= words
        if room < 0:
            break
        least = s
    got = counts.where(step >= least).toPandas() if least is not None else None
    words = got["word"].to_numpy(np.int64).view(np.uint64) if got is not None else np.zeros(0, np.uint64)
    n = got["n"].to_numpy(np.int64) if got is not None else np.zeros(0, np.int64)
    order = np.argsort(words)
    words, n = words[order], n[order]
    tokens, distinct = sum(s[2] for s in steps) + ends, sum(s[1] for s in steps) + (ends > 0)
    top = np.lexsort((words, -n))[: VOCABULARY - 2]
    ids = np.full(len(words), OTHER, np.int32)
    ids[top] = np.arange(2, 2 + len(top))
    total = tokens + SMOOTH * (distinct + 1)
    unigram = np.zeros(VOCABULARY)
    unigram[END] = (ends + SMOOTH) / total
    unigram[2 : 2 + len(top)] = (n[top] + SMOOTH) / total
    unigram[OTHER] = max(1e-12, 1 - unigram.sum())
    return Head(words, n, ids, tokens, distinct, ends, unigram)


# ---- ids ----------------------------------------------------------------------------------------------------------

PARTS = "doc_id long, held_out boolean, place long, n_tokens long, head_known long, head_base double, other double, ids binary, tail array<struct<word:long,n:long>>"


def ids_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2").astype(np.int64)


def _encode(head: Head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, log_mass = float(head.base(head.ends)), math.log10(head.mass)
        # per word of the head, and last for all others: its id, its base and what follows from them
        id_of, log_of = np.append(head.ids, OTHER).astype("<u2"), np.append(head.base(head.counts), 0.0)
        other_of = np.where(id_of == OTHER, log_of - log_mass, 0.0)
        known_of = np.append(head.counts > 0, False)
        for batch in portions(batches):
            ids, tokens, known, base, other, tails = [], [], [], [], [], []
            for _, run_ in slabs(batch.column("text").to_pylist()):
                hashes, counts = word_hashes(run_)
                k = head.index(hashes)
                found = k < len(head.words)
                doc = np.repeat(np.arange(len(counts)), counts)
                flat, edges = id_of[k].tobytes(), (2 * np.cumsum(np.append(0, counts))).tolist()
                ids += [flat[a:b] for a, b in itertools.pairwise(edges)]
                tokens += (counts + 1).tolist()
                known += (np.bincount(doc, known_of[k], len(counts)).astype(np.int64) + (head.ends > 0)).tolist()
                base += (np.bincount(doc, log_of[k], len(counts)) + end).tolist()
                # what a word of OTHER has besides the model's probability: its base probability over that of all of them
                other += np.bincount(doc, other_of[k], len(counts)).tolist()
                rare, whose = hashes[~found].view(np.int64), doc[~found]
                order = np.lexsort((rare, whose))
                rare, whose = rare[order], whose[order]
                new = np.flatnonzero(np.concatenate([[True], (rare[1:] != rare[:-1]) | (whose[1:] != whose[:-1])])) if len(rare) else np.zeros(0, np.int64)
                tails.append((np.bincount(whose[new], minlength=len(counts)), rare[new], np.diff(np.append(new, len(rare)))))
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([t[0] for t in tails]))]) if tails else np.zeros(1)
            cat = lambda k: pa.array(np.concatenate([t[k] for t in tails]).astype(np.int64) if tails else np.zeros(0, np.int64))
            tail = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays([cat(1), cat(2)], ["word", "n"]))
            numbers = [pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(other, pa.float64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "held_out", "place")), *numbers, tail], [c.split()[0] for c in PARTS.split(", ")])

    return run


def encode(docs: DataFrame, head: Head) -> DataFrame:
    """Per row of (doc_id, text, held_out) its words as the model's ids, two bytes each, what the head gives of its base, the words
    that the head has not, and the hash of id and text by which it is dealt to a shard. Texts are read for this and not shuffled."""
    place = F.xxhash64(F.lit(SEED), "doc_id", "text").alias("place")
    return materialise(docs.select("doc_id", "text", "held_out", place).mapInArrow(_encode(head), PARTS).withColumn("row", F.monotonically_increasing_id()), "ids")


# ---- the network --------------------------------------------------------------------------------------------------

SHAPES = {
    "embed": (VOCABULARY, EMBED),
    "input": (EMBED, 3 * HIDDEN),
    "state": (HIDDEN, 3 * HIDDEN),
    "bias": (3 * HIDDEN,),
    "group": (GROUPS, HIDDEN + 1),  # the last column is the bias, here and below
    "class": (CLASSES, HIDDEN + 1),
    "word": (VOCABULARY, HIDDEN + 1),
}
#: Tables of which an update touches some rows only.
TABLES = ("embed", "word")
Weights = dict[str, np.ndarray]


def place_of(unigram: np.ndarray) -> np.ndarray:
    """Each model word's place: words by falling frequency, class after class."""
    place = np.zeros(VOCABULARY, np.int64)
    place[np.argsort(-unigram, kind="stable")] = np.arange(VOCABULARY)
    return place


def start(unigram: np.ndarray) -> Weights:
    """Before training the softmax gives just the unigram distribution."""
    rng = np.random.default_rng(SEED)
    w = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    for k in ("embed", "input", "state"):
        w[k] = rng.normal(0, SHAPES[k][1] ** -0.5 if k == "state" else EMBED**-0.5 if k == "input" else 0.5, SHAPES[k]).astype(np.float32)
    p = np.maximum(np.sort(unigram)[::-1], 1e-12)
    total = np.add.reduceat(p, FIRST[:-1])
    groups = np.add.reduceat(total, GROUP_FIRST[:-1])
    w["group"][:, -1] = np.log(groups)
    w["class"][:, -1] = np.log(total / groups[np.arange(CLASSES) // GROUP])
    w["word"][:, -1] = np.log(p / total[CLASS_OF])
    return w


def pack_weights(w: Weights) -> bytes:
    return b"".join(np.ascontiguousarray(w[k], np.float32).tobytes() for k in SHAPES)


def unpack_weights(data: bytes) -> Weights:
    flat, out, at = np.frombuffer(data, np.float32), {}, 0
    for k, s in SHAPES.items():
        n = math.prod(s)
        out[k] = flat[at : at + n].reshape(s).copy()
        at += n
    return out


def step(w: Weights, x: np.ndarray, h: np.ndarray):
    """One step of the gated unit: x are embedded words times the input matrix, with the bias. Rows are lanes, stored column
    after column, so that gates are stretches of memory."""
    gate = (w["state"].T @ h.T).T
    rz = x[:, : 2 * HIDDEN] + gate[:, : 2 * HIDDEN]
    rz *= 0.5
    np.tanh(rz, out=rz)
    rz *= 0.5
    rz += 0.5
    r, z, inner = rz[:, :HIDDEN], rz[:, HIDDEN:], gate[:, 2 * HIDDEN :]
    n = r * inner
    n += x[:, 2 * HIDDEN :]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, (r, z, n, inner)


def _softmax(h: np.ndarray, w: np.ndarray, at: np.ndarray, back: np.ndarray | None = None, grad: np.ndarray | None = None) -> np.ndarray:
    """Natural log probability of column `at` of each row's softmax over h @ w.T; weights are held within LARGEST, so that no
    exponential overflows. With `back` and `grad`, adds the gradients of minus the sum with respect to h and w. Sums of rows
    are divided out on the narrow side: the wide array is passed over as seldom as can be."""
    x = h @ w.T
    cells = x.ravel()
    at = at + np.arange(0, x.size, x.shape[1])
    own = cells[at]
    np.exp(x, out=x)
    total = x @ ONES[: x.shape[1]].astype(x.dtype, copy=False)
    if back is not None:
        cells[at] -= total
        share = (1 / total)[:, None]
        grad += x.T @ (h * share)
        back += (x @ w) * share
    return own - np.log(total)


def _softmaxes(h: np.ndarray, w: np.ndarray, rows: np.ndarray, at: np.ndarray, back: np.ndarray | None = None, grad: np.ndarray | None = None) -> np.ndarray:
    """_softmax of several classes of equally many words as one product of stacks: w is (classes, words, width), `rows` how many
    rows of h each class has, one class after another. Shorter classes are filled up with rows of zeros, which add nothing."""
    most = int(rows.max())
    real = np.flatnonzero(np.arange(most) < rows[:, None])
    stack = np.zeros((len(rows) * most, h.shape[1]), h.dtype)
    stack[real] = h
    x = stack.reshape(len(rows), most, -1) @ w.transpose(0, 2, 1)
    cells = x.ravel()
    at = at + real * x.shape[2]
    own = cells[at]
    np.exp(x, out=x)
    total = x.reshape(len(stack), -1) @ ONES[: x.shape[2]].astype(x.dtype, copy=False)
    sums = total[real]
    if back is not None:
        cells[at] -= sums
        stack *= (1 / total)[:, None]
        grad += x.transpose(0, 2, 1) @ stack.reshape(len(rows), most, -1)
        back += (x @ w).reshape(stack.shape)[real] * (1 / sums)[:, None]
    return own - np.log(sums)


def log_probability(w: Weights, h: np.ndarray, place: np.ndarray, grads: Weights | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of the words at `place` after the states h: that of the group, of the class within the group and
    of the word within the class. With `grads`, adds the gradients of minus the sum and returns the one with respect to h.
    Rows are worked on by class."""
    kind = CLASS_OF[place]
    order = np.argsort(kind, kind="stable")
    place, kind = place[order], kind[order]
    states = np.ones((len(h), HIDDEN + 1), h.dtype)
    states[:, :-1] = h[order]
    ends = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    logs, back = np.zeros(len(h)), np.zeros_like(states)

    def add(lo: int, hi: int, key: str, words: slice, at: np.ndarray) -> np.ndarray:
        learn = (back[lo:hi], grads[key][words]) if grads is not None else ()
        return _softmax(states[lo:hi], w[key][words], at, *learn)

    def each(key: str, own: np.ndarray, edges: list[int], first: np.ndarray) -> None:
        for k, (begin, end) in enumerate(itertools.pairwise(edges)):
            for lo in range(begin, end, ROWS_AT_ONCE):
                hi = min(lo + ROWS_AT_ONCE, end)
                logs[lo:hi] += add(lo, hi, key, slice(first[k], first[k + 1]), own[lo:hi] - first[k])

    each("group", kind // GROUP, [0, len(h)], np.array([0, GROUPS]))
    each("class", kind, [ends[c] for c in GROUP_FIRST], GROUP_FIRST)
    for begin, end, words in RUNS:
        rows = np.diff(ends[begin : end + 1])
        few = rows <= 2 * rows.mean()
        # classes that have like numbers of rows go together, runs of them between the others
        edges = [begin, *(begin + np.flatnonzero(np.diff(few)) + 1).tolist(), end]
        for a, b in itertools.pairwise(edges):
            most = int(rows[a - begin : b - begin].max())
            if b - a > 1 and 0 < most * (b - a) * words <= CELLS_AT_ONCE:
                lo, hi, span = ends[a], ends[b], slice(FIRST[a], FIRST[b])
                stack = lambda key: key[span].reshape(b - a, words, HIDDEN + 1)  # noqa: B023, E731
                learn = (back[lo:hi], stack(grads["word"])) if grads is not None else ()
                logs[lo:hi] += _softmaxes(states[lo:hi], stack(w["word"]), rows[a - begin : b - begin], place[lo:hi] - FIRST[kind[lo:hi]], *learn)
            else:
                each("word", place, ends[a : b + 1], FIRST[a : b + 1])
    turn = np.empty_like(order)
    turn[order] = np.arange(len(order))
    return logs[turn], back[turn, :-1] if grads is not None else None


class Trainer:
    """Weights under training: Adagrad on the rows that an update touches, Adam on the rest."""

    def __init__(self, w: Weights):
        self.w, self.seen, self.t = w, 0, 0
        self.squares = {k: np.full(x.shape, 1e-6, np.float32) if k in TABLES else np.zeros_like(x) for k, x in w.items()}
        self.mean = {k: np.zeros_like(x) for k, x in w.items() if k not in TABLES}
        self.grads = {k: np.zeros_like(x) for k, x in w.items()}

    def update(self, size: int, embedded: np.ndarray) -> None:
        w, g, self.t = self.w, self.grads, self.t + 1
        norm = math.sqrt(sum(float((g[k] ** 2).sum()) for k in self.mean)) / size
        scale = np.float32((min(1.0, CLIP / norm) if norm > 0 else 1.0) / size)
        for k in TABLES:
            for lo in range(0, len(embedded) if k == "embed" else VOCABULARY, TABLE_ROWS):
                rows = embedded[lo : lo + TABLE_ROWS] if k == "embed" else slice(lo, lo + TABLE_ROWS)  # nearly all words' classes are touched
                x, square, table = g[k][rows], self.squares[k][rows], w[k][rows]
                x *= scale
                square += x * x
                x /= np.sqrt(square)
                x *= np.float32(TABLE_RATE)
                table -= x
                if k == "word":  # views; the bias is not held within bounds
                    bias = table[:, -1].copy()
                    np.clip(table, -LARGEST, LARGEST, out=table)
                    table[:, -1] = bias
                else:
                    self.squares[k][rows], w[k][rows] = square, table
                g[k][rows] = 0
        for k, m in self.mean.items():
            x, v = g[k] * scale, self.squares[k]
            m += 0.1 * (x - m)
            v += 0.001 * (x * x - v)
            w[k] -= RATE * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-7)
            g[k][:] = 0
        for k in ("class", "group"):
            np.clip(w[k][:, :-1], -LARGEST, LARGEST, out=w[k][:, :-1])

    def train(self, docs: list[np.ndarray], place: np.ndarray) -> None:
        """Backpropagation truncated at STEPS steps: the documents, each with its end, form one stream that is cut into up to
        LANES lanes side by side; states run on. Lanes differ by a word at most, so every word is learned once."""
        w = self.w
        stream = np.concatenate([np.append(d, END) for d in docs]) if docs else np.zeros(0, np.int64)
        if not len(stream):
            return
        lanes = max(1, min(LANES, len(stream) // (64 * STEPS)), min(LEAST_LANES, len(stream) // (2 * STEPS)))
        bounds = np.arange(lanes + 1) * len(stream) // lanes
        sizes = np.diff(bounds)
        order = np.argsort(-sizes, kind="stable")
        begin, sizes = bounds[:-1][order], sizes[order]
        before = np.concatenate([[END], stream[:-1]])
        h = np.zeros((lanes, HIDDEN), np.float32, "F")
        for lo in range(0, int(sizes[0]), STEPS):
            width = min(STEPS, int(sizes[0]) - lo)
            live = [int(np.count_nonzero(sizes > lo + k)) for k in range(width)]
            at = [begin[:n] + lo + k for k, n in enumerate(live)]
            flat = np.concatenate(at)
            ids, want = before[flat], place[stream[flat]]
            embedded = w["embed"][ids]
            x = (w["input"].T @ embedded.T + w["bias"][:, None]).T
            edge = np.cumsum([0, *live])
            kept, states, after = [], np.empty((len(ids), HIDDEN), np.float32, "F"), np.empty((len(ids), HIDDEN), np.float32)
            for k, n in enumerate(live):
                states[edge[k] : edge[k + 1]] = h[:n]
                h, inner = step(w, x[edge[k] : edge[k + 1]], h[:n])
                kept.append(inner)
                after[edge[k] : edge[k + 1]] = h
            _, back = log_probability(w, after, want, self.grads)
            back = np.asfortranarray(back)
            dx, later, g = np.empty_like(x, order="F"), np.zeros((live[-1], HIDDEN), np.float32, "F"), self.grads
            dgates = np.empty_like(x, order="F")
            for k in range(width - 1, -1, -1):
                (r, z, n, inner), prev = kept[k], states[edge[k] : edge[k + 1]]
                dh = back[edge[k] : edge[k + 1]]
                dh[: len(later)] += later
                dn = dh * (1 - z) * (1 - n * n)
                part = dx[edge[k] : edge[k + 1]]
                part[:, HIDDEN : 2 * HIDDEN] = dh * (prev - n) * z * (1 - z)
                part[:, :HIDDEN] = dn * inner * r * (1 - r)
                part[:, 2 * HIDDEN :] = dn
                dgate = dgates[edge[k] : edge[k + 1]]
                dgate[:, : 2 * HIDDEN] = part[:, : 2 * HIDDEN]
                np.multiply(dn, r, out=dgate[:, 2 * HIDDEN :])
                later = dh * z
                later += (w["state"] @ dgate.T).T
            g["state"] += states.T @ dgates
            g["bias"] += dx.sum(0)
            g["input"] += embedded.T @ dx
            turn = np.argsort(ids.astype(np.uint16), kind="stable")
            sorted_ids = ids[turn]
            first = np.flatnonzero(np.concatenate([[True], np.diff(sorted_ids) > 0]))
            used = sorted_ids[first]
            g["embed"][used] = np.add.reduceat((dx @ w["input"].T)[turn], first, axis=0)
            self.update(len(ids), used)
            self.seen += len(ids)


def _rows_of(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[int, list]]:
    """Texts (or ids) of a shard, up to ROWS or SIZE at a time, wherever batches end: (shard, texts)."""
    now, texts, size = None, [], 0
    for batch in batches:
        for shard, text in zip(batch.column("shard").to_pylist(), batch.column(column).to_pylist(), strict=True):
            if texts and (shard != now or len(texts) == ROWS or size + len(text) > SIZE):
                yield now, texts
                texts, size = [], 0
            now, size = shard, size + len(text)
            texts.append(text)
    if texts:
        yield now, texts


def _train(head: Head, data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, trainer, now = place_of(head.unigram), None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([trainer.seen], pa.int64()), pa.array([pack_weights(trainer.w)], pa.binary())], ["shard", "tokens", "weights"])
        for shard, rows in _rows_of(batches, "ids"):
            if shard != now:
                if trainer is not None:
                    yield done()
                trainer, now = Trainer(unpack_weights(data)), shard
            trainer.train([ids_of(x) for x in rows], place)
        if trainer is not None:
            yield done()

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of a task's models: their weights by trained tokens, added up."""
    tokens, sums = 0, None
    for batch in batches:
        for n, weights, added in zip(*(batch.column(c) for c in ("tokens", "weights", "sums")), strict=True):
            x = np.frombuffer(added.as_buffer(), np.int64) if added.is_valid else np.rint(np.frombuffer(weights.as_buffer(), np.float32) * np.float64(UNIT)).astype(np.int64) * n.as_py()
            tokens, sums = tokens + n.as_py(), x if sums is None else sums + x
    if sums is not None:
        yield pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([None], pa.binary()), pa.array([sums.tobytes()], pa.binary())], ["tokens", "weights", "sums"])


def _average(t: pa.Table) -> bytes:
    """The mean of all models by trained tokens."""
    got = next(_add_up(t.select(["tokens", "weights", "sums"]).to_batches()))
    return (np.frombuffer(got.column("sums")[0].as_py(), np.int64) / (got.column("tokens")[0].as_py() * UNIT)).astype(np.float32).tobytes()


def fit(docs: DataFrame, head: Head) -> Weights:
    """The network, from rows of (doc_id, text)."""
    return fit_ids(encode(docs.withColumn("held_out", F.lit(False)), head), head)


def fit_ids(docs: DataFrame, head: Head) -> Weights:
    """Rows are dealt to shards by their place, and sorted within; a shard trains by itself, first on a share of its rows,
    then, from the average of all shards, on all others, so that each row is used once. Weights are averaged by trained
    tokens, in whole numbers, so that their order is of no matter. Neither partitions nor batches of the input change the outcome."""
    data = pack_weights(start(head.unigram))
    shards = max(math.ceil(head.tokens / SHARD_TOKENS), min(SHARDS, head.tokens // SHARD_LEAST), 1)
    first = F.pmod("place", F.lit(ONE_OF)) == 0
    for part in (first, ~first):
        rows = docs.where(part).select(F.pmod(F.shiftright("place", 8), F.lit(shards)).alias("shard"), "place", "doc_id", "ids")
        share = rows.repartition("shard").sortWithinPartitions("shard", "place", "doc_id", "ids").select("shard", "ids")
        models = materialise(share.mapInArrow(_train(head, data), "shard long, tokens long, weights binary").where("tokens > 0"), "models")
        models, n = models.select("tokens", "weights", F.lit(None).cast("binary").alias("sums")), models.count()
        most = FAN_IN
        while n > most:  # models are added up where they are read: weights are most of what training writes, and are not shuffled
            models = materialise(models.coalesce(math.ceil(n / FAN_IN)).mapInArrow(_add_up, "tokens long, weights binary, sums binary"), "models")
            n, most = models.count(), max(1, FAN_IN // 2)  # a sum has twice the bytes of a model
        got = models.toArrow()
        if len(got):
            data = _average(got)
    return unpack_weights(data)


# ---- scores -------------------------------------------------------------------------------------------------------


def score_ids(w: Weights, docs: list[np.ndarray], place: np.ndarray) -> np.ndarray:
    """Natural log probability of each whole document with its end. Documents stand one after another in up to WIDE lanes, of
    which there are no more than keep busy beside the longest document; a lane's state starts anew with each document and is
    carried from window to window, however long a document is."""
    out, lengths = np.zeros(len(docs)), np.array([len(d) + 1 for d in docs], np.int64)
    if not len(docs):
        return out
    lanes = int(min(WIDE, len(docs), -(-lengths.sum() // lengths.max())))
    free, lane_of = [(0, k) for k in range(lanes)], np.zeros(len(docs), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():  # the longest first, each to the lane that ends first
        size, lane_of[i] = free[0]
        heapq.heapreplace(free, (size + int(lengths[i]), free[0][1]))
    sizes = np.bincount(lane_of, lengths, lanes).astype(np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    rank = np.empty_like(by_size)
    rank[by_size] = np.arange(lanes)
    sizes, order = sizes[by_size], np.argsort(rank[lane_of], kind="stable")
    begin = np.cumsum(sizes) - sizes
    stream = np.full(int(sizes.sum()), END, np.uint16)
    starts = np.cumsum(lengths[order]) - lengths[order]
    for i, at in zip(order.tolist(), starts.tolist(), strict=True):
        stream[at : at + len(docs[i])] = docs[i]
    before, new = np.concatenate([np.full(1, END, np.uint16), stream[:-1]]), np.zeros(len(stream), bool)
    new[starts] = True
    whose = np.repeat(order.astype(np.int32), lengths[order])
    states, spots, rows = [], [], 0

    def add_up() -> None:
        at = np.concatenate(spots)
        logs, _ = log_probability(w, np.concatenate(states), place[stream[at]])
        out[:] += np.bincount(whose[at], logs, len(docs))
        for x in (states, spots):
            x.clear()

    h = np.zeros((lanes, HIDDEN), np.float32, "F")
    for lo in range(0, int(sizes[0]), WINDOW):
        width = min(WINDOW, int(sizes[0]) - lo)
        live = np.count_nonzero(sizes > lo)
        at = begin[:live] + np.arange(lo, lo + width)[:, None]  # beyond a lane's end stands what is not used
        np.minimum(at, len(stream) - 1, out=at)
        x = (w["input"].T @ w["embed"][before[at.ravel()]].T + w["bias"][:, None]).T
        fresh = new[at]
        any_fresh = fresh.any(1).tolist()
        lives = (live - np.searchsorted(sizes[:live][::-1], np.arange(lo, lo + width), "right")).tolist()
        for k, n in enumerate(lives):
            h = h[:n]
            if any_fresh[k]:
                h[np.flatnonzero(fresh[k, :n])] = 0
            h = step(w, x[k * live : k * live + n], h)[0]
            states.append(h.copy("C"))
            spots.append(at[k, :n])
            rows += n
            if rows >= TOGETHER:
                add_up()
                rows = 0
    if rows:
        add_up()
    return out


def _score(unigram: np.ndarray, data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, place = unpack_weights(data), place_of(unigram)

        def scored(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = score_ids(w, [np.frombuffer(x.as_buffer(), "<u2") for b in some for x in b.column("ids")], place) / math.log(10)
            at = 0
            for b in some:
                kept = [c for c in b.schema.names if c != "ids"]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(model[at : at + b.num_rows], pa.float64())], [*kept, "model"])
                at += b.num_rows

        some, size = [], 0
        for batch in portions(batches, "ids"):
            n = pc.sum(pc.binary_length(batch.column("ids"))).as_py() or 0
            if some and size + n > BESIDE:
                yield from scored(some)
                some, size = [], 0
            some.append(batch)
            size += n
        if some:
            yield from scored(some)

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text, held_out, ...): token counts, base_score and score, each over the whole text and its end.

    Counts are taken from all rows that are not held out; words are known by 64-bit hashes. The counts of frequent words, a
    bounded table, go to every task; those of the rest are joined to the rows that have them, by word. A word outside the
    model's vocabulary has the model's probability of OTHER times its share in the base distribution of all such words.
    Words are looked up once: training and scoring read ids. Null and empty texts are an end alone. Repeated rows are counted and scored each. Without training rows every word is unknown;
    an empty table gives none. Texts of any length are scored whole, in memory of their ids; other columns are left out.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "held_out")
    learn = docs.where(~F.col("held_out"))
    counts = materialise(learn.select("text").mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    head = head_of(counts, learn.count())
    parts = encode(docs, head)
    weights = pack_weights(fit_ids(parts.where(~F.col("held_out")), head))
    kept = parts.select("row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "other", F.aggregate("tail", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("tail_tokens"), "ids")
    scored = kept.mapInArrow(_score(head.unigram, weights), "row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_base double, other double, tail_tokens long, model double")
    scored = materialise(scored, "scored")
    total, log_mass = head.tokens + SMOOTH * (head.distinct + 1), math.log10(head.mass)
    tail = parts.select("row", F.explode("tail").alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.n").alias("times"))
    seen = F.coalesce("n", F.lit(0))
    tail = tail.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((seen + SMOOTH) / total)).alias("tail_base"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("tail_known"),
    )
    rare = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + rare("tail_known")).cast("long").alias("n_known"),
        F.lit(head.tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + rare("tail_base")).alias("base_score"),
        (F.col("model") + F.col("other") + rare("tail_base") - F.col("tail_tokens") * log_mass).alias("score"),
    )


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out")))
