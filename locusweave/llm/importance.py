"""Importance resampling towards a target text: hashed word n-grams of documents and of the target, weights, Gumbel noise, a draw."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, table

#: Fixed by the operator's contract.
BUCKETS, LONGEST, LEAST_WORDS, SHARE = 10_000, 3, 20, 5
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Ends a text of a batch; no word holds it.
SENTINEL = b"\x00"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bytes of text that are joined and searched at once; a longer text is joined by itself.
SLAB = 1 << 21
#: Words up to this length have a table each for appending them to a checksum.
TABLED = 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


CRC = _crc_table()


def _zeros_after(c: np.ndarray, n: int) -> np.ndarray:
    """The checksum register after n more zero bytes."""
    for _ in range(n):
        c = CRC[c & 255] ^ (c >> np.uint32(8))
    return c


def _shifts() -> np.ndarray:
    """For lengths up to TABLED and each byte of a register, what the byte becomes after so many zero bytes; the register is their xor."""
    out = np.zeros((TABLED + 1, 4, 256), np.uint32)
    for k in range(4):
        c = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for n in range(TABLED + 1):
            out[n, k] = c
            c = _zeros_after(c, 1)
    return out


_SHIFTS = _shifts()
_EDGE = np.uint32(0xFFFFFFFF)


def _append(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksums of strings a + b from those of a and b and the bytes of b."""
    n = np.minimum(size, TABLED)
    out = _SHIFTS[n, 0, left & 255]
    for k in range(1, 4):
        out ^= _SHIFTS[n, k, (left >> np.uint32(8 * k)) & 255]
    for i in np.flatnonzero(size > TABLED):
        out[i] = _zeros_after(out[i : i + 1], int(size[i]) - TABLED)[0]
    return out ^ right


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every data[start:end], one byte of all of them at a time; the few very long ones last, each by itself."""
    size = ends - starts
    c = np.full(len(starts), _EDGE)
    alive = np.arange(len(starts))
    for j in range(TABLED):
        alive = alive[size[alive] > j]
        if not len(alive):
            break
        now = c[alive]
        c[alive] = CRC[(now ^ data[starts[alive] + j]) & 255] ^ (now >> np.uint32(8))
    c ^= _EDGE
    for i in np.flatnonzero(size > TABLED):
        c[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return c


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all runs of 1 to LONGEST words of the texts, the number of each one's text, and the words of each text.

    The texts are joined with a sentinel after each and searched once; a word's text follows from its place among the texts'
    offsets, and a run whose first and last words are of different texts is masked.
    """
    joined = SENTINEL.join([*texts, b""]).translate(_LOWER)
    found = list(WORDS.finditer(joined))
    starts = np.fromiter((m.start() for m in found), np.int64, len(found))
    ends = np.fromiter((m.end() for m in found), np.int64, len(found))
    del found
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    owner = np.searchsorted(offsets, starts, "right") - 1
    size = ends - starts
    word = _checksums(np.frombuffer(joined, np.uint8), starts, ends)
    space = np.full(len(word), np.uint32(0xE96CCF45))  # of one space
    buckets, owners, run = [word], [owner], word
    for k in range(1, LONGEST):
        run = _append(run[:-1], space[: max(len(run) - 1, 0)], np.ones(max(len(run) - 1, 0), np.int64))
        run = _append(run, word[k:], size[k:])
        inside = owner[k:] == owner[: len(run)]
        buckets.append(run[inside])
        owners.append(owner[: len(run)][inside])
    return np.concatenate(buckets) % np.uint32(BUCKETS), np.concatenate(owners), np.bincount(owner, minlength=len(texts))


def _slabs(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    run, size, first = [], 0, 0
    for i, value in enumerate(column):
        text = b"" if not value.is_valid else value.as_buffer().to_pybytes()
        if run and size + len(text) > SLAB:
            yield first, run
            run, size, first = [], 0, i
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, texts in _slabs(batch.column("text")):
            total += np.bincount(features(texts)[0], minlength=BUCKETS)
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(met.astype(np.int32)), "n": pa.array(total[met])})


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n) over all features of all texts; each task adds up its own, at most BUCKETS rows."""
    return texts.select("text").mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket: BUCKETS numbers, whatever the input."""
    s, t = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for texts, counts in ((docs, s), (target, t)):
        got = bucket_counts(texts).toArrow()
        counts[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    ratio = ((t + 1) * float(s.sum() + BUCKETS)) / ((s + 1) * float(t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, sizes, weights = (np.zeros(n, np.int64) for _ in range(3))
            for first, texts in _slabs(batch.column("text")):
                bucket, owner, counts = features(texts)
                here = slice(first, first + len(texts))
                words[here], sizes[here] = counts, np.bincount(owner, minlength=len(texts))
                order = np.argsort(owner, kind="stable")
                sums = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
                ends = np.cumsum(sizes[here])
                weights[here] = sums[ends] - sums[ends - sizes[here]]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_words": pa.array(words), "n_features": pa.array(sizes), "weight": pa.array(weights)})

    return run


def weigh(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) per row: the sum of the gains of its features, and with the document's noise added."""
    rows = docs.select("doc_id", "text").mapInArrow(_weigh(gains(docs, target)), "doc_id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit("42:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    return rows.withColumn("score", F.col("weight") + noise)


#: Rows that a task ranks, about.
STRIPE = 1_000_000


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """Every row's doc_id, n_words, n_features, weight, score, and its rank if drawn.

    Of the N rows with at least 20 words those of the floor(share * N / 100) highest scores are drawn. The score axis is cut into
    stripes at quantiles; the rows of each are counted, and only stripes that the draw reaches are sorted, each by itself. So no
    task sees all that is drawn, and no row is compared with all others.

    A null or empty text has no features and weight 0; texts of any length are taken whole. A null doc_id counts as an empty
    one for the noise and comes last among ties. Repeated rows each count and are ranked each; ties go to the smaller doc_id. An empty table or an
    empty target gives weights as the formula says and no draw from nothing. Other columns are not read.
    """
    rows = materialise(weigh(docs, target), "weighed")
    fit = F.col("n_words") >= LEAST_WORDS
    n = rows.where(fit).count()
    drawn = share * n // 100
    # so many stripes above the quantile that bounds twice the draw; where the quantiles are rough, stripes only differ in size
    stripes = max(1, min(1000, 2 * drawn // STRIPE))
    at = [1 - min(1, 2 * share / 100) * k / stripes for k in range(1, stripes + 1)]
    edges = rows.where(fit).agg(F.percentile_approx("score", at, max(10_000, 1000 * stripes)).alias("e")).first()["e"] if drawn else []
    edges = sorted(set(edges))
    # stripe 0 has the highest scores
    over = F.array_size(F.filter(F.array(*map(F.lit, edges)), lambda e: e > F.col("score"))) if edges else F.lit(0)
    rows = rows.withColumn("stripe", F.when(fit, over.cast("int")))
    sizes = {r["stripe"]: r["n"] for r in rows.where(fit).groupBy("stripe").agg(F.count("*").alias("n")).collect()}
    before, first = {}, 0
    for stripe in sorted(sizes):
        before[stripe], first = first, first + sizes[stripe]
    reached = {s: b for s, b in before.items() if b < drawn}
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    none = rows.where(F.col("stripe").isNull() | ~F.col("stripe").isin(list(reached))).select(*columns, F.lit(None).cast("long").alias("rank"))
    if not reached:
        return none
    place = F.row_number().over(W.partitionBy("stripe").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    start = F.create_map(*(F.lit(x) for s, b in reached.items() for x in (s, b)))[F.col("stripe")]
    ranked = rows.where(F.col("stripe").isin(list(reached))).withColumn("rank", (place + start).cast("long"))
    return none.unionByName(ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")
