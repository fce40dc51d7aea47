"""Operator 3: mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import exclusive_prefix, materialise, n_words, table, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
SEED = "mix-1"
#: Hex digits of the shuffle key that name a bucket of a source: 4096 buckets.
BUCKET_DIGITS = 3


def shuffle_key(seed: str = SEED) -> Column:
    """A document's place in the shuffle, from its id and text: rows without an id do not share one."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text_of())))


def slot(finish: Column) -> Column:
    """A number that never falls along virtual time: 2048 to a unit up to time 2, then 64 to a doubling."""
    return F.when(finish < 2, F.floor(finish * 2048)).otherwise(4096 + F.floor(F.log2(F.greatest(finish, F.lit(2.0))) * 64)).cast("int")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = MOST_REPEATS) -> DataFrame:
    """Per source (key, source, source_size): its target.

    Sources by code point, null last, take the weights in turn. Giving each source weight x level, stopped at its cap, with
    the level such that the targets add up to the budget, is the fixed point of resharing the excess by weight: sources are
    taken by cap / weight, and the one whose cap lies over the level that the remaining budget gives is the first free one.
    One row per source is all that this ever sees.
    """
    everything = W.partitionBy(F.lit(0))
    nth = F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int"))
    tight = everything.orderBy("__ratio", "__key")
    earlier, rest = tight.rowsBetween(W.unboundedPreceding, -1), tight.rowsBetween(0, W.unboundedFollowing)
    return (
        sizes.withColumn("weight", weight.cast("double"))
        .withColumn("__cap", (repeats * F.col("source_size")).cast("double"))
        .withColumn("__ratio", F.col("__cap") / F.col("weight"))
        .withColumn("__budget", share * F.sum("source_size").over(everything))
        .withColumn("__level", (F.col("__budget") - F.coalesce(F.sum("__cap").over(earlier), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("__free", F.when(F.col("__ratio") > F.col("__level"), F.col("__level")))
        .withColumn("__level", F.max("__free").over(everything))
        .withColumn("target", F.least(F.col("__cap"), F.coalesce(F.col("__level") * F.col("weight"), F.col("__cap"))))
        .select("__key", "source_size", "target")
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = MOST_REPEATS) -> DataFrame:
    """Adds source_size, target, finishes, parts and taken to rows of (doc_id, source, size, shuffle, ...), see sized().

    Each source's documents stand in shuffled order, `repeats` times over. Every copy has a virtual finish time: the source's
    words up to its end over the source's target. The stream of all copies, sorted by range of that time, is cut where its
    words reach the total budget: copies before the cut are taken whole, the one that the cut goes through in part. A source
    ends within a document of its target. `finishes` and `parts` are the times and the words taken of each copy.

    Only sums by stretches of virtual time and the one row at the cut are ever gathered, so neither the stream nor a source
    passes through one task. Null sources are a source of their own, standing last. Null doc_ids and repeated rows are rows
    like any other; rows that repeat the one at the cut get its part. Documents without words are taken with 0. An empty table
    stays empty; texts of any length count by their words alone. Columns of the input that bear the name of a result are replaced.
    """
    docs = docs.drop("source_size", "target", "finishes", "parts", "taken", "virtual_finish")
    keyed = docs.withColumn("__key", F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("="), "source"))).withColumn(
        "__bucket", F.conv(F.substring("shuffle", 1, BUCKET_DIGITS), 16, 10).cast("int")
    )
    sources = keyed.groupBy("__key", "source").agg(F.sum("size").alias("source_size"))
    placed = exclusive_prefix(keyed, ["__key"], "__bucket", ["shuffle", "size"], {"__before": "size"}).join(targets(sources, weights, share, repeats), "__key")
    finish = [F.when(F.col("target") > 0, (F.col("__before") + e * F.col("source_size") + F.col("size")) / F.col("target")) for e in range(repeats)]
    placed = placed.withColumn("finishes", F.array(*finish))
    copies = placed.where("size > 0").select("size", "shuffle", "__key", F.explode("finishes").alias("finish")).withColumn("__slot", slot(F.col("finish")))
    stream = exclusive_prefix(copies, [], "__slot", ["finish", "shuffle", "__key"], {"at": "size"})
    budget = sources.agg(F.floor(F.sum("source_size") * share).alias("budget"))
    here = F.struct("finish", "shuffle", F.col("__key").alias("key"), (F.col("budget") - F.col("at")).alias("part"))
    cut = stream.join(F.broadcast(budget)).where("at < budget AND at + size >= budget").agg(F.min(here).alias("cut"))
    part = lambda t: (
        F.when(F.col("size") == 0, 0)
        .when(F.col("cut").isNull() | (F.struct(t.alias("finish"), "shuffle", F.col("__key").alias("key")) < F.struct("cut.finish", "cut.shuffle", "cut.key")), F.col("size"))
        .when((t == F.col("cut.finish")) & (F.col("shuffle") == F.col("cut.shuffle")) & (F.col("__key") == F.col("cut.key")), F.col("cut.part"))
        .otherwise(0)
    )
    out = placed.join(F.broadcast(cut)).withColumn("parts", F.transform("finishes", lambda t: part(t).cast("long")))
    return out.withColumn("taken", F.aggregate("parts", F.lit(0).cast("long"), lambda a, b: a + b)).drop("__key", "__bucket", "__before", "cut")


def mixed_stream(docs: DataFrame, **options) -> DataFrame:
    """mix(), sorted by range over the whole table: the order in which a trainer reads."""
    return mix(docs, **options).withColumn("virtual_finish", F.get("finishes", F.lit(0))).orderBy("virtual_finish", "doc_id", "size")


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, the number of words and the place in the shuffle: all that mixing needs of a document."""
    return docs.select("doc_id", "source", n_words().alias("size"), shuffle_key(seed).alias("shuffle"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = materialise(sized(table(spark, sf_dir, "documents")), "op3-sizes")
    return mixed_stream(docs).select("doc_id", "size", "source_size", "target", "taken", "virtual_finish")


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM d GROUP BY source
), c AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, cap / weight AS ratio, 1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS budget FROM s
), l AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM c
), t AS (
  SELECT source, source_size, least(cap, coalesce(max(CASE WHEN ratio > lev THEN lev END) OVER () * weight, cap)) AS target FROM l
), p AS (
  SELECT d.doc_id, d.source, k, size, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), st AS (
  SELECT v, k, size, coalesce(sum(size) OVER (ORDER BY v, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM (SELECT k, size, CAST(before + e * source_size + size AS DOUBLE) / target AS v FROM p, (VALUES (0), (1)) c(e) WHERE size > 0)
), cut AS (
  SELECT v AS cv, k AS ck, b - pos AS part FROM st, (SELECT floor(1.5 * sum(source_size)) AS b FROM s) WHERE pos < b AND pos + size >= b ORDER BY v, k LIMIT 1
), f AS (
  SELECT doc_id, size, source_size, target, k, CASE WHEN target > 0 THEN CAST(before + size AS DOUBLE) / target END AS v0,
    CASE WHEN target > 0 THEN CAST(before + source_size + size AS DOUBLE) / target END AS v1 FROM p
)
SELECT doc_id, size, source_size, target, v0 AS virtual_finish,
  CAST(CASE WHEN size = 0 THEN 0 ELSE
    CASE WHEN cv IS NULL OR v0 < cv OR (v0 = cv AND k < ck) THEN size WHEN v0 = cv AND k = ck THEN part ELSE 0 END
    + CASE WHEN cv IS NULL OR v1 < cv OR (v1 = cv AND k < ck) THEN size WHEN v1 = cv AND k = ck THEN part ELSE 0 END END AS BIGINT) AS taken
FROM f LEFT JOIN cut ON true
"""
