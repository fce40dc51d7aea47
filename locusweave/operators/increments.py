"""A stored interval union that takes in new elements by rewriting only what they touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.operators.rangejoin import overlap_join
from locusweave.operators.union import STRETCH, interval_union, stretch_number
from locusweave.sources.store import stored


def write_union(rows: DataFrame, keys: Sequence[str], path: str, stretch: int = STRETCH) -> None:
    """The union of rows as a table of islands, partitioned by the stretch in which an island starts."""
    islands = interval_union(rows, keys, stretch).withColumn("stretch", stretch_number("start", stretch))
    islands.write.partitionBy("stretch").parquet(path)


def read_union(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("stretch")


def add_to_union(rows: DataFrame, keys: Sequence[str], path: str, stretch: int = STRETCH) -> list[int]:
    """Adds elements to a stored union; gives the stretches that were rewritten. Files of others stay as they are.

    New elements are merged among themselves. Stored islands that share a base with one of these leave the table, and their union
    with the new ones comes in; an island that meets no new one cannot meet the result either. `strand` is that of the part that
    starts first. Only stretches in which an island leaves or comes in are read whole and replaced; there are at most as many
    as new islands and those they touch. The result is stored first, as a table cannot be read and replaced at once.
    """
    spark = rows.sparkSession
    old = spark.read.parquet(path)
    new = stored(interval_union(rows, keys, stretch), "new-islands")
    columns = [*keys, "start", "stop", "strand"]
    named = new.select(*keys, F.col("start").alias("__a"), F.col("stop").alias("__b"))
    met = stored(overlap_join(named, old.select(*columns, "stretch"), keys, ("__a", "__b"), ("start", "stop")).select(*columns, "stretch").distinct(), "met-islands")
    merged = stored(interval_union(met.select(*columns).unionByName(new.select(*columns)), keys, stretch).withColumn("stretch", stretch_number("start", stretch)), "merged-islands")
    changed = sorted(r[0] for r in met.select("stretch").unionByName(merged.select("stretch")).distinct().collect())
    if not changed:
        return []
    kept = old.where(F.col("stretch").isin(changed)).join(met.select(*keys, "start"), [*keys, "start"], "left_anti")
    after = stored(kept.select(*old.columns).unionByName(merged.select(*old.columns)), "changed-stretches")
    # a stretch whose last island went would keep its old files: nothing is written to it, so it is emptied first
    empty = [s for s in changed if after.where(F.col("stretch") == s).isEmpty()] if after.select("stretch").distinct().count() < len(changed) else []
    after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stretch").parquet(path)
    for s in empty:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/stretch={s}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return changed
