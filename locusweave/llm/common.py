"""What the operators share: table access, the shared scratch folder, distributed prefix sums."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The white space that separates words, in Java, Python and RE2 syntax alike.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that a Python worker holds at once; with whole texts in them, Spark's default of 10 000 is too many.
BATCH = "2000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or (in local mode, where it is unset) an own one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="locusweave-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


#: Rows of a few longs in a file of a table whose size is known.
ROWS_A_FILE = 20_000


def materialise(df: DataFrame, what: str, rows: int | None = None) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: the lineage ends there, a lost executor costs nothing.

    `rows` bounds the rows of df and of what its last stage reads, all of a few numbers: a small table is then written as few
    files, whatever the number of partitions. Each file that Hadoop creates in a local folder costs the executor a fork for
    its permissions, in which the child counts with the executor's whole memory.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    path = fresh_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(name), F.lit(""))


def n_words(name: str = "text") -> Column:
    return F.regexp_count(text_of(name), F.lit(WORD)).cast("long")


def exclusive_prefix(df: DataFrame, by: Sequence[str], bucket: str, order: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Adds, for each (output, input) of `values`, the sum of the input over the rows of the same `by` that stand before the row.

    `bucket` is an integer column that never falls along `order` within a group. Sums over (group, bucket) are taken first,
    so a group that holds a third of all rows is dealt over as many tasks as it has buckets; no task sees a whole group.
    """
    keys = [*by, bucket]
    sums = df.groupBy(*keys).agg(*(F.sum(v).alias(f"__s_{k}") for k, v in values.items()))
    before = W.partitionBy(*by).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*keys, *(F.coalesce(F.sum(f"__s_{k}").over(before), F.lit(0)).alias(f"__b_{k}") for k in values))
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    joined = df.join(sums, keys)
    return joined.select(*df.columns, *((F.col(f"__b_{k}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(k) for k, v in values.items()))
