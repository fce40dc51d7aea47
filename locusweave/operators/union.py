"""Interval union (gaps and islands) and the three revisions of an annotation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.schema import O_REVISION, S_REVISION, TOTAL
from locusweave.sources.store import stored

#: Base pairs of a stretch that one task sorts.
STRETCH = 1 << 22


def interval_union(df: DataFrame, keys: Sequence[str], stretch: int = STRETCH) -> DataFrame:
    """Merges closed intervals [start, stop] that share a base, per `keys`; adjacent ones stay apart.

    `strand` is the first interval's. Rows with a null key or coordinate are left out. No task sees a whole key: intervals are
    merged within the stretch where they start. Of the islands of a stretch only the last can reach into later ones, so a table
    with one row per key and stretch tells what comes in from before: how far it reaches and where it began. Islands that it
    touches join it. Rows are read once, shuffled once and sorted once, as the islands of stretches are stored in the shared
    folder; then only these move.
    """
    at = [*keys, "__stretch"]
    rows = df.dropna(subset=[*keys, "start", "stop"]).select(*keys, "start", "stop", "strand")
    rows = rows.withColumn("__stretch", stretch_number("start", stretch))
    before = F.max("stop").over(W.partitionBy(*at).orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    begin = F.when(F.col("__before").isNull() | (F.col("start") > F.col("__before")), F.col("start"))
    # rows of one start may stand in any order, so each sees what all of them begin
    island = F.max("__begin").over(W.partitionBy(*at).orderBy("start").rangeBetween(W.unboundedPreceding, 0))
    marked = rows.withColumn("__before", before).withColumn("__begin", begin).withColumn("__island", island)
    local = marked.groupBy(*at, "__island").agg(*_merged("start", "stop", F.struct("start", "stop", "strand")))
    return _joined(stored(local.drop("__island"), "islands"), keys).select(*keys, "start", "stop", F.col("first.strand").alias("strand"), (F.col("stop") - F.col("start") + 1).alias("length"))


def stretch_number(column: str, size: int) -> Column:
    """Number of the stretch that holds a position, also a negative one, in whole numbers."""
    return F.expr(f"({column} - pmod({column}, {size})) div {size}")


def _merged(start: str, stop: str, first: Column) -> list[Column]:
    return [F.min(start).alias("start"), F.max(stop).alias("stop"), F.min(first).alias("first")]


def _joined(local: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Islands of stretches (keys, __stretch, start, stop, first) that reach over a border become one with what they touch there."""
    along = W.partitionBy(*keys).orderBy("__stretch").rowsBetween(W.unboundedPreceding, -1)
    ends = local.groupBy(*keys, "__stretch").agg(F.max("start").alias("__start"), F.max("stop").alias("__stop")).withColumn("__reach", F.max("__stop").over(along))
    own = F.when(F.col("__reach").isNull() | (F.col("__start") > F.col("__reach")), F.col("__start"))
    ends = ends.withColumn("__from", F.max(own).over(along)).where("__reach IS NOT NULL").select(*keys, "__stretch", "__reach", "__from")
    islands = local.join(ends, [*keys, "__stretch"], "left")
    touched = F.when(F.col("start") <= F.col("__reach"), F.col("__from")).otherwise(F.col("start"))
    return islands.withColumn("__island", touched).groupBy(*keys, "__island").agg(*_merged("start", "stop", F.col("first")))


def _revised(tes: DataFrame, genome: Sequence[str], te_order, superfamily) -> DataFrame:
    return tes.where(F.col("chrom").isNotNull()).select(*genome, "chrom", "start", "stop", "strand", te_order.alias("te_order"), superfamily.alias("superfamily"))


def superfamily_rows(tes: DataFrame, genome: Sequence[str] = ()) -> DataFrame:
    return _revised(tes, genome, F.lit(S_REVISION), F.col("superfamily"))


def order_rows(tes: DataFrame, genome: Sequence[str] = ()) -> DataFrame:
    return _revised(tes, genome, F.col("te_order"), F.lit(O_REVISION))


def total_rows(tes: DataFrame, genome: Sequence[str] = ()) -> DataFrame:
    return _revised(tes, genome, F.lit(TOTAL), F.lit(TOTAL))


def revision_rows(tes: DataFrame, genome: Sequence[str] = ()) -> DataFrame:
    """Each element three times, relabelled for the union per superfamily, per order and over all; one scan and no union."""
    label = lambda order, family: F.struct(order.alias("te_order"), family.alias("superfamily"))
    labels = F.array(label(F.lit(S_REVISION), F.col("superfamily")), label(F.col("te_order"), F.lit(O_REVISION)), label(F.lit(TOTAL), F.lit(TOTAL)))
    rows = tes.where(F.col("chrom").isNotNull()).select(*genome, "chrom", "start", "stop", "strand", F.explode(labels).alias("l"))
    return rows.select(*genome, "chrom", "start", "stop", "strand", "l.te_order", "l.superfamily")


def revise(tes: DataFrame, genome: Sequence[str] = ()) -> DataFrame:
    """Islands per superfamily, per order and over all, as one table. The relabelled rows keep the three unions apart, so
    that one pass makes them all."""
    return interval_union(revision_rows(tes, genome), [*genome, "chrom", "te_order", "superfamily"])
