"""A training-data pipeline over `documents`: each stage is written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locusweave.llm import stages
from locusweave.llm.common import materialise, table

STAGES = [
    ("quality_classifier", stages.keep_good),
    ("ngram_jaccard_join", stages.keep_one_of_near),
    ("secret_scans", stages.hide_secrets),
    ("mixing", stages.mix_sources),
    ("packing", stages.pack_windows),
]

#: Learned weights and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
