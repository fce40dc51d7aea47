"""Tables that cut lineage: written once to the folder that driver and executors share, read by all that follows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode, where it is unset, a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="locusweave-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stored(rows: DataFrame, what: str) -> DataFrame:
    """The rows as a written table: computed once however often they are used, and not again when an executor is lost."""
    path = f"{shared_folder(rows.sparkSession)}/{what}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def files_at(spark: SparkSession, path: str):
    """A path and the file system that has it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file whole or not at all: under another name first, which is then changed."""
    there, files = files_at(spark, path)
    draft, _ = files_at(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = files.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(there, False)
    if not files.rename(draft, there):
        raise OSError(f"cannot write {path}")
