"""Operator 7: packing tokenised documents into windows by non-negative least squares over length combinations."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import exclusive_prefix, materialise, table

WINDOW = 2048
END_ID = 1
BUCKETS = 256
#: How ids travel to their pieces: the vocabulary has under 65 536.
ID = "<u2"


class Tokens:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes, equal to those of tokenizers with byte_bpe_50k.json.

    The same vocabulary as ranks gives the same ids in a quarter of the time. The end mark's own text is its one special id,
    as it is for tokenizers by default.
    """

    SPECIAL = "<|endoftext|>"

    def __init__(self, ranks: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={self.SPECIAL: len(table)})

    def __call__(self, text: str) -> bytes:
        special = {self.SPECIAL} if self.SPECIAL in text else set()
        return self.encoding.encode_to_numpy(text, allowed_special=special, disallowed_special=()).astype("<u4").tobytes()


def bits_of(n: int) -> list[int]:
    """The powers of two that n adds up to, largest first."""
    return [1 << j for j in range(n.bit_length() - 1, -1, -1) if n >> j & 1]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, end = Tokens(), np.asarray([END_ID], "<u4").tobytes()
    for batch in batches:
        keep, rows, every = "ids" in batch.schema.names, [], []
        for text in batch.column("text").to_pylist():
            ids = memoryview(tokens(text or "") + end)
            every.append(np.frombuffer(ids, "<u4").astype(ID).tobytes() if keep else None)
            n = len(ids) // 4
            full, rest = divmod(n, WINDOW)
            at, bits = 4 * full * WINDOW, []
            for size in bits_of(rest):
                bits.append(zlib.crc32(ids[at : at + 4 * size]))
                at += 4 * size
            rows.append((n, rest, [zlib.crc32(ids[4 * WINDOW * k : 4 * WINDOW * (k + 1)]) for k in range(full)], zlib.crc32(ids[4 * WINDOW * full :]), bits))
        n, rest, full, tail, bits = zip(*rows, strict=True) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(rest, pa.int32()), pa.array(full, pa.list_(pa.int64())), pa.array(tail, pa.int64()), pa.array(bits, pa.list_(pa.int64())), *([pa.array(every, pa.binary())] if keep else [])],
            ["doc_id", "doc_tokens", "rest", "full_crc", "rest_crc", "bit_crc", *(["ids"] if keep else [])],
        )


def combinations(window: int = WINDOW) -> np.ndarray:
    """All multisets of two or three lengths under `window` that fill it, padded with zeros, one in a row."""
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([a, window - a, np.zeros_like(a)], 1)
    x, y = np.meshgrid(np.arange(1, window // 3 + 1), np.arange(1, window // 2 + 1), indexing="ij")
    x, y = x.ravel(), y.ravel()
    z = window - x - y
    good = (x <= y) & (y <= z)
    return np.concatenate([pairs, np.stack([x[good], y[good], z[good]], 1)]).astype(np.int32)


def solve(combos: np.ndarray, have: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Repeat counts x >= 0 that come near |A x - have| least, by accelerated projected gradient. A has 2 or 3 ones a column."""
    usable = (have[combos[:, 0]] > 0) & (have[combos[:, 1]] > 0) & ((combos[:, 2] == 0) | (have[combos[:, 2]] > 0))
    x = np.zeros(len(combos))
    rows = combos[usable]
    if not len(rows):
        return x
    live = np.ones(len(have))
    live[0] = 0  # the padding of pairs
    back = lambda r: (r * live)[rows].sum(1)
    ahead = lambda v: sum(np.bincount(rows[:, k], v, len(have)) for k in range(3)) * live
    v = np.ones(len(rows))
    for _ in range(8):  # the largest eigenvalue of A'A
        v = back(ahead(v))
        norm = np.linalg.norm(v)
        v /= norm
    step, now, last, t = 1 / (1.05 * norm), np.zeros(len(rows)), np.zeros(len(rows)), 1.0
    for _ in range(rounds):
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = now + (t - 1) / nt * (now - last)
        last, now, t = now, np.maximum(0, y - step * back(ahead(y) - have)), nt
    x[usable] = now
    return x


@dataclass
class Plan:
    """Where the remainders of documents go. A remainder is known by its length and its rank among those of that length."""

    have: np.ndarray  # remainders of each length
    planned: np.ndarray  # ranks below this belong to combinations
    length: np.ndarray  # of each interval of ranks, sorted by (length, low)
    low: np.ndarray
    sequence: np.ndarray  # of the interval's first rank
    offset: np.ndarray
    windows: int  # sequences of combinations

    def __post_init__(self):
        rest = self.have - self.planned
        sizes = 1 << np.arange(11)
        has = (np.arange(WINDOW)[:, None] & sizes[None, :]) > 0
        per = np.where(has, rest[:, None], 0)
        #: Per length and power of two: the residual pieces of that size from shorter lengths.
        self.before = np.concatenate([np.zeros((1, 11), np.int64), np.cumsum(per, 0)[:-1]])
        total = per.sum(0) * sizes
        #: Pieces stand largest first, so each is aligned to its size.
        self.start = np.concatenate([np.cumsum(total[::-1])[::-1][1:], [0]])
        self.tokens = int(total.sum())
        self.keys = self.length.astype(np.int64) << 40 | self.low
        #: The tail of under a window falls into sequences of powers of two, which need no padding.
        self.tail = np.cumsum([0, *bits_of(self.tokens % WINDOW)])
        self.residual_sequences = self.tokens // WINDOW + max(0, len(self.tail) - 1)
        self.first_full = self.windows + self.residual_sequences
        self.index = np.concatenate([[0], np.cumsum(self.have)[:-1]])

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of remainders that belong to combinations."""
        k = np.searchsorted(self.keys, length.astype(np.int64) << 40 | rank, "right") - 1
        return self.sequence[k] + rank - self.low[k], self.offset[k]

    def place_bit(self, length: np.ndarray, rank: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of a residual document's piece of 2 ** bit ids."""
        at = self.start[bit] + ((self.before[length, bit] + rank - self.planned[length]) << bit)
        window, offset = at // WINDOW, at % WINDOW
        last = window == self.tokens // WINDOW
        chunk = np.searchsorted(self.tail, offset, "right") - 1
        return self.windows + window + np.where(last, chunk, 0), offset - np.where(last, self.tail[chunk], 0)


def plan(have: np.ndarray) -> Plan:
    """Solves for repeat counts, rounds them down as far as the histogram goes, then tops up greedily, largest counts first."""
    combos = combinations()
    x = solve(combos, have.astype(float))
    left, used, lengths = have.astype(np.int64).tolist(), {}, combos.tolist()
    order = np.argsort(-x, kind="stable")
    order = order[: np.count_nonzero(x > 1e-6)].tolist()
    for most in (np.floor(x).astype(np.int64).tolist(), None):
        for c in order:
            a, b, d = lengths[c]
            n = min(left[a], left[b]) if a != b else left[a] // 2
            if d:
                n = left[a] // 3 if a == b == d else min(n, left[d] if d != b else left[b] // 2)
            n = n if most is None else min(n, most[c])
            if n > 0:
                used[c] = used.get(c, 0) + n
                for ell in (a, b, d):
                    left[ell] -= n
            left[0] = 0
    planned, rows, at = np.zeros(len(have), np.int64), [], 0
    for c, n in used.items():
        offset = 0
        for ell in sorted((e for e in lengths[c] if e), reverse=True):
            rows.append((ell, int(planned[ell]), at, offset))
            planned[ell] += n
            offset += ell
        at += n
    rows.sort()
    length, low, sequence, offset = (np.asarray(col, np.int64) for col in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 4
    return Plan(have.astype(np.int64), planned, length, low, sequence, offset, at)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pieces(goal: Plan, most_full: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = lambda k: batch.column(k).to_numpy(zero_copy_only=False)
            doc, n, rest, rank = np.arange(batch.num_rows), col("doc_tokens"), col("rest").astype(np.int64), col("rank")
            flat = lambda k: (batch.column(k).flatten().to_numpy(), np.diff(batch.column(k).offsets.to_numpy()))
            parts = []
            crc, many = flat("full_crc")
            who, nth = np.repeat(doc, many), np.arange(len(crc)) - np.repeat(np.cumsum(many) - many, many)
            own = goal.first_full + (goal.index[rest] + rank) * most_full
            parts.append((who, nth * WINDOW, np.full(len(crc), WINDOW), crc, own[who] + nth, np.zeros(len(crc), np.int64)))
            whole = (rest > 0) & (rank < goal.planned[rest])
            if whole.any():
                seq, off = goal.place(rest[whole], rank[whole])
                parts.append((doc[whole], n[whole] - rest[whole], rest[whole], col("rest_crc")[whole], seq, off))
            crc, many = flat("bit_crc")
            who = np.repeat(doc, many)
            bits = np.concatenate([[], *(np.log2(bits_of(int(r))) for r in rest)]).astype(np.int64)
            size = np.left_shift(1, bits)
            done = np.cumsum(size) - size
            start = (n - rest)[who] + done - np.repeat((np.cumsum(rest) - rest), many)
            cut = ~whole[who]
            if cut.any():
                seq, off = goal.place_bit(rest[who[cut]], rank[who[cut]], bits[cut])
                parts.append((who[cut], start[cut], size[cut], crc[cut], seq, off))
            who, start, length, crc, seq, off = (np.concatenate([p[k] for p in parts]) for k in range(6))
            columns = [batch.column("doc_id").take(pa.array(who)), *(pa.array(a.astype(np.int64)) for a in (start, length, crc, n[who], seq, off))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if "ids" in batch.schema.names:
                flat, first = np.frombuffer(b"".join(batch.column("ids").to_pylist()), ID), (np.cumsum(n) - n)[who] + start
                ends = np.cumsum(length)
                ids = flat[np.repeat(first - ends + length, length) + np.arange(ends[-1])].astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pack(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """Cuts the ids of each row of (doc_id, text, ...) into pieces and gives each its place in a sequence.

    Full windows of a document are sequences of their own. A remainder goes whole into a combination of two or three
    remainders that fills a window exactly; repeat counts of combinations come from non-negative least squares against the
    histogram of remainders, which is all that the driver sees (2047 counts, whatever the input). Remainders that no
    combination takes are cut into powers of two and laid out largest first, which fills windows without a gap; the tail of
    under one window is cut into sequences of powers of two. No sequence needs padding.

    With `with_ids` each piece carries its ids, of which a sequence is made up in the order of `offset`. Sequence numbers have
    gaps: documents with full windows hold a run of numbers each, as long as the longest needs.

    A null or empty text is its end id alone; texts of any length are encoded whole. Other columns are not read. Repeated rows are packed each on its own; null doc_ids are kept; an empty
    table has no pieces. Ranks follow (bucket of doc_id, doc_id), so that reruns agree.
    """
    more = ["ids"] if with_ids else []
    texts = docs.select("doc_id", "text", *(F.lit(None).alias(c) for c in more))
    cut = materialise(texts.mapInArrow(_measure, "doc_id long, doc_tokens long, rest int, full_crc array<long>, rest_crc long, bit_crc array<long>" + ", ids binary" * with_ids), "pieces")
    counts = cut.groupBy("rest").agg(F.count("*").alias("n"), F.max(F.size("full_crc")).alias("full")).collect()  # 2048 rows at most
    have = np.zeros(WINDOW, np.int64)
    for r in counts:
        have[r["rest"]] = r["n"]
    at_zero = int(have[0])
    have[0] = 0
    goal = plan(have)
    goal.index[1:] += at_zero
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")
    ranked = exclusive_prefix(cut.withColumn("bucket", bucket).withColumn("one", F.lit(1)), ["rest"], "bucket", ["doc_id", "doc_tokens", "rest_crc"], {"rank": "one"})
    return ranked.select("doc_id", "doc_tokens", "rest", "full_crc", "rest_crc", "bit_crc", F.col("rank").cast("long").alias("rank"), *more).mapInArrow(
        _pieces(goal, max([1, *(r["full"] for r in counts)])), PIECES + ", ids array<int>" * with_ids
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
