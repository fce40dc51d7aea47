"""Operator 8: a quality classifier of random-indexing word vectors, pooled per document, and a two-layer network."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .hashing import SHAPES, mix64, pieces, shingle_sets, slabs, word_hashes, word_shapes

#: Rows of the word vectors (words share rows by hash), their dimensions, and the neighbours on each side that make a context.
ROWS, DIM, REACH = 16384, 32, 2
#: Most labelled documents that the network is fitted on, those first by hash.
MOST_LABELLED = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 256, 3e-3, 1e-4
#: Standard deviations beyond which a feature counts no further.
OUTERMOST = 3.0
ACCEPT = 0.7
SEED = 20240801
#: Words whose vectors are looked up at once.
CHUNK = 1 << 18


def index_vectors(n: int, seed: int) -> np.ndarray:
    """Sparse ternary random vectors: a quarter of the components are +-1."""
    rng = np.random.default_rng(seed)
    return (rng.choice([-1, 1], (n, DIM)) * (rng.random((n, DIM)) < 0.25)).astype(np.float32)


def word_rows(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) % ROWS


def contexts(docs: list[str | None], total: np.ndarray, index: np.ndarray) -> None:
    """Adds to each word's row the index vectors of the words up to REACH before and after it in the same document. A long
    text is taken in pieces, at whose ends contexts stop, so that memory is bounded."""
    for run in (part for _, run in slabs(docs) for part in ([run] if len(run) > 1 else [[p] for p in pieces(run[0])])):
        hashes, counts = word_hashes(run)
        if not len(hashes):
            continue
        rows, doc = word_rows(hashes), np.repeat(np.arange(len(counts)), counts)
        around = np.zeros((len(rows), DIM), np.float32)
        for k in range(1, REACH + 1):
            same = (doc[k:] == doc[:-k])[:, None]
            around[k:] += index[rows[:-k]] * same
            around[:-k] += index[rows[k:]] * same
        order = np.argsort(rows, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(rows[order]) > 0]))
        total[rows[order][first]] += np.add.reduceat(around[order], first, axis=0)


def _sum_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, index = np.zeros((ROWS, DIM), np.float64), index_vectors(ROWS, SEED)
    for batch in batches:
        contexts(batch.column("text").to_pylist(), total, index)
    used = np.flatnonzero(np.abs(total).sum(1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(total[used, k]) for k in range(DIM))], ["row", *(f"v{k}" for k in range(DIM))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """One vector per row: its context over all documents, of unit length, plus a little of its own index vector.

    Each task adds up its own part; the driver gets ROWS sums, however large the corpus is.
    """
    names = [f"v{k}" for k in range(DIM)]
    parts = docs.select("text").mapInArrow(_sum_contexts, "row int, " + ", ".join(f"{n} double" for n in names))
    sums = parts.groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    out = np.zeros((ROWS, DIM))
    out[sums["row"].to_numpy()] = np.round(sums[names].to_numpy(), 3)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1) + 0.3 * index_vectors(ROWS, SEED)).astype(np.float32)


def pooled(vectors: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows' vectors from each start to the next; a long stretch is summed in parts."""
    if len(rows) <= CHUNK:
        return np.add.reduceat(vectors[rows], starts, axis=0)
    out = np.zeros((len(starts), vectors.shape[1]))
    for i, (a, b) in enumerate(zip(starts, np.append(starts[1:], len(rows)), strict=True)):
        for lo in range(a, b, CHUNK):
            out[i] += vectors[rows[lo : min(b, lo + CHUNK)]].sum(0)
    return out


def features(texts: list[str | None], vectors: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Per text: the means of its words' context vectors and shape vectors, and the shares that pooling loses: how many words and
    three-word runs are distinct, and the text's size. Texts without words have zeros."""
    out = np.zeros((len(texts), 2 * DIM + 5))
    for first, run in slabs(texts):
        hashes, counts = word_hashes(run)
        if not len(hashes):
            continue
        full = np.flatnonzero(counts)
        starts = np.cumsum(counts)[full] - counts[full]
        rows = word_rows(hashes)
        n = counts[full][:, None]
        out[first + full, :DIM] = pooled(vectors, rows, starts) / n
        out[first + full, DIM : 2 * DIM] = pooled(shapes, word_shapes(run), starts) / n
        doc = np.repeat(np.arange(len(counts)), counts)
        distinct = np.unique(mix64(hashes ^ mix64(doc.astype(np.uint64))) >> np.uint64(24) << np.uint64(24) | doc.astype(np.uint64))
        out[first + full, 2 * DIM] = (np.bincount((distinct & np.uint64((1 << 24) - 1)).astype(np.int64), minlength=len(counts)) / np.maximum(counts, 1))[full]
        out[first + full, 2 * DIM + 1] = np.log1p(counts[full]) / 8
        out[first + full, 2 * DIM + 2] = np.array([len(run[i]) for i in full]) / counts[full] / 10
    for i, s in enumerate(shingle_sets(texts, 3)):
        words = math.expm1(8 * out[i, 2 * DIM + 1])
        out[i, 2 * DIM + 3] = len(s) / max(1.0, words - 2)
    out[:, 2 * DIM + 4] = np.linalg.norm(out[:, :DIM], axis=1)
    return out


def within(z: np.ndarray) -> np.ndarray:
    """Features no further out than OUTERMOST deviations: a text much longer than those labelled is not judged by its length."""
    return np.clip(z, -OUTERMOST, OUTERMOST)


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(within((x - self.mean) / self.scale) @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Adam on the log loss over nine tenths of the rows; the temperature is what makes the log loss least on the other tenth."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    check, use = order[: len(x) // 10], order[len(x) // 10 :]
    mean, scale = x[use].mean(0), x[use].std(0) + 1e-3
    z, t = within((x[use] - mean) / scale), y[use].astype(float)
    p = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 + math.cos(math.pi * epoch / EPOCHS)) / 2
        turn = rng.permutation(len(z))
        for lo in range(0, len(z), BATCH):
            a, want = z[turn[lo : lo + BATCH]], t[turn[lo : lo + BATCH]]
            h = np.maximum(a @ p[0] + p[1], 0)
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - want) / len(a)
            back = d[:, None] * p[2] * (h > 0)
            grads = [a.T @ back + DECAY * p[0], back.sum(0), h.T @ d + DECAY * p[2], np.array([d.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    if len(check):
        logits, want = net.logit(x[check]), y[check]
        loss = lambda temp: np.logaddexp(0, -np.where(want == 1, 1, -1) * logits / temp).mean()
        net.temperature = float(min(np.geomspace(0.5, 8, 81), key=loss))
    return net


def held_out(doc_id: str = "doc_id", of: int = 4, rest: int = 2):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of == rest


def _collect_features(vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = index_vectors(SHAPES, SEED + 1)
        for batch in batches:
            x = features(batch.column("text").to_pylist(), vectors, shapes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    return run


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network]:
    """Word vectors of all documents, and the network fitted on at most MOST_LABELLED labelled rows that are not held out.

    Labels other than 0 and 1 are not used, nor those of an id that has both; of rows that repeat a labelled id the text that is
    first by hash counts. Without a usable label the network is all zeros: every score is 1/2.
    """
    vectors = word_vectors(docs)
    some = labels.where(~held_out() & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
    some = some.agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("other")).where("quality = other")
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED).select("doc_id", "quality")
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    got = rows.mapInArrow(_collect_features(vectors), "doc_id long, quality int, x array<double>").toPandas().sort_values("doc_id", kind="stable")
    width = 2 * DIM + 5
    if not len(got):
        return vectors, Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    return vectors, fit(np.stack(got["x"].to_list()), got["quality"].to_numpy())


def _score(vectors: np.ndarray, net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = index_vectors(SHAPES, SEED + 1)
        for batch in batches:
            score = net.score(features(batch.column("text").to_pylist(), vectors, shapes)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, ...) with score, 0 to 1, higher where label 1 is likelier.

    One pass over the text for the word vectors, one for the labelled rows, one for the scores; no shuffle of texts. Null and
    empty texts get the score of a text without words; repeated rows score alike; texts of any length are scored whole; an empty
    table gives none. A column named score is replaced, others stay, whatever their names.
    """
    docs = docs.drop("score")
    vectors, net = train(docs, labels)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(_score(vectors, net), schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
