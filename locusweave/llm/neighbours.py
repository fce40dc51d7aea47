"""Operator 5: nearest neighbours by a block matrix join over int8 product tiles with error bounds."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

K = 10
EVERY = 100
#: Bytes of the candidate vectors (as single floats) that a block holds, rows a product tile takes, and blocks that small data are dealt to.
BLOCK_BYTES, TILE, SPREAD = 64 << 20, 4096, 12
#: Dimensions over which sums of products of codes stay under 2 ** 24.
EXACT = 1024
#: Pairs whose exact distances are computed at once.
PAIRS = 1 << 15
CANDIDATE, QUERY = 0, 1
FOUND = "query_id long, query_key long, vec_id long, score double"


def usable(vector: str = "embedding") -> Column:
    """Not null, not empty, every component there and finite, not all zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")), F.lit(False)))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes (held as float32, in which their products are exact), scales, squared norms of what they stand for, and norms of the errors."""
    scale = np.abs(v).max(1) / 127
    scale[scale == 0] = 1.0
    code = np.clip(np.rint(v / scale[:, None]), -127, 127)
    meant = code * scale[:, None]
    return code.astype(np.float32), scale, (meant**2).sum(1), np.sqrt(((v - meant) ** 2).sum(1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: float32 holds sums of up to EXACT of them, beyond which parts are added in double precision."""
    if a.shape[1] <= EXACT:
        return a @ b.T
    total = np.zeros((len(a), len(b)))
    for j in range(0, a.shape[1], EXACT):
        total += a[:, j : j + EXACT] @ b[:, j : j + EXACT].T
    return total


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of a to rows of b, components added in order."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        d = a[:, j] - b[:, j]
        total += d * d
    return np.sqrt(total)


@dataclass
class Tile:
    """Candidates as they meet queries: int8 codes with what bounds their errors, and the vectors for the exact recheck."""

    ids: np.ndarray
    vectors: np.ndarray
    code: np.ndarray
    scale: np.ndarray
    norm: np.ndarray
    error: np.ndarray


def tiles_of(vectors: np.ndarray, ids: np.ndarray) -> Iterator[Tile]:
    for at in range(0, len(vectors), TILE):
        part = vectors[at : at + TILE]
        code, scale, norm, error = quantise(part.astype(np.float64))
        yield Tile(ids[at : at + TILE], part, code.astype(np.int8), scale, norm, error)


def search_block(queries: np.ndarray, query_ids: np.ndarray, tiles: list[Tile], k: int = K) -> list[list[tuple[float, int]]]:
    """Per query its k nearest (distance, id) of the block, own id left out.

    A tile's int8 products bound every distance from both sides. What lies, at its least, beyond the k-th best upper bound
    or beyond the k-th exact distance so far is out; the rest is measured in double precision and goes through a heap.
    """
    heaps: list[list[tuple[float, int]]] = [[] for _ in queries]
    qc, qs, qn, qe = quantise(queries)
    for tile in tiles:
        code = tile.code.astype(np.float32)
        for lo in range(0, len(queries), 1024):
            hi = min(lo + 1024, len(queries))
            squared = qn[lo:hi, None] + tile.norm[None, :] - 2 * (qs[lo:hi, None] * tile.scale[None, :]) * products(qc[lo:hi], code)
            near = np.sqrt(np.maximum(squared, 0))
            slack = qe[lo:hi, None] + tile.error[None, :] + 1e-6 * (1 + near)
            own = query_ids[lo:hi, None] == tile.ids[None, :]
            upper = np.where(own, np.inf, near + slack)
            limit = np.partition(upper, k - 1, 1)[:, k - 1] if upper.shape[1] > k else np.full(hi - lo, np.inf)
            worst = np.array([-h[0][0] if len(h) == k else np.inf for h in heaps[lo:hi]])
            rows, cols = np.nonzero(~own & (near - slack <= np.minimum(limit, worst)[:, None]))
            for s in range(0, len(rows), PAIRS):
                r, c = rows[s : s + PAIRS], cols[s : s + PAIRS]
                exact = distances(queries[r + lo], tile.vectors[c].astype(np.float64))
                for q, d, name in zip((r + lo).tolist(), exact.tolist(), tile.ids[c].tolist(), strict=True):
                    heap, item = heaps[q], (-d, -name)
                    if len(heap) < k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)
    return [sorted((-d, -i) for d, i in h) for h in heaps]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """The batch cut where block, length of vectors or kind change: (block, length), kind, rows."""
    keys = np.stack([batch.column(c).to_numpy() for c in ("block", "dim", "kind")], 1)
    edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi > lo:
            block, dim, kind = keys[lo].tolist()
            yield (block, dim), kind, batch.slice(lo, hi - lo)


def _meet(k: int):
    """Rows come by block and length, candidates first: these are kept as tiles, queries pass by a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tiles = None, []
        for batch in batches:
            for key, kind, rows in _runs(batch):
                if key != held:
                    held, tiles = key, []
                ids = rows.column("vec_id").to_numpy()
                if kind == CANDIDATE:
                    tiles += tiles_of(_matrix(rows).copy(), ids.copy())  # views would keep the whole batch
                    continue
                found = search_block(_matrix(rows).astype(np.float64), ids, tiles, k)
                sizes = [len(f) for f in found]
                flat = [pair for f in found for pair in f]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids, sizes), pa.int64()),
                        pa.array(np.repeat(rows.column("query_key").to_numpy(), sizes), pa.int64()),
                        pa.array([i for _, i in flat], pa.int64()),
                        pa.array([d for d, _ in flat], pa.float64()),
                    ],
                    [c.split()[0] for c in FOUND.split(", ")],
                )

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The k nearest rows of `vectors` (vec_id, embedding) for each row of `queries`: query_id, rank, vec_id, score.

    Exact: bounds only save work. Candidates are dealt to blocks by a hash and shuffled once, whatever the number of queries;
    every query goes to every block. A task holds one block, bounded in bytes whatever the length of vectors, while queries
    pass it in batches. The lists that a query gets from its blocks are merged by a window that keeps k rows before and
    after the shuffle. Unusable vectors, and rows without an id, take no part; vectors of different lengths do not meet. A
    query row that is repeated as it is counts once; candidates that are repeated count each. Fewer than k candidates give
    fewer rows, empty tables none. Other columns are left out, whatever their names.
    """
    good = lambda df: df.where(usable() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.size("embedding").alias("dim"))
    vectors, queries = good(vectors), good(queries).dropDuplicates()
    n, components = vectors.agg(F.count("*"), F.coalesce(F.sum(F.col("dim").cast("long")), F.lit(0))).first()
    blocks = max(math.ceil(4 * components / BLOCK_BYTES), min(SPREAD, math.ceil(n / TILE)), 1)
    deal = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int")
    row = lambda kind, block, key: ["vec_id", "embedding", "dim", F.lit(kind).alias("kind"), block.alias("block"), key.alias("query_key")]
    rows = vectors.select(*row(CANDIDATE, deal, F.lit(0).cast("long"))).unionByName(
        queries.select(*row(QUERY, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), F.xxhash64("embedding")))
    )
    found = rows.repartitionById(blocks, "block").sortWithinPartitions("block", "dim", "kind").mapInArrow(_meet(k), FOUND)
    rank = F.row_number().over(W.partitionBy("query_id", "query_key").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), q AS (
  SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 100 = 0
), p AS (
  SELECT q.vec_id AS query_id, q.e AS qe, v.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, v.e), lambda t: (t[1] - t[2]) * (t[1] - t[2])), lambda a, b: a + b)) AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id, qe ORDER BY score, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
