"""The operators as stages over whole documents: each takes and returns tables with the columns of documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard_join, mixing, packing, quality_classifier, secrets
from .common import materialise, n_words, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates in the pipeline: shingles of five words, Jaccard similarity of 0.8.
NEAR_WORDS, NEAR_NUM, NEAR_DEN = 5, 80, 100
#: Sources up to which the table of them is broadcast (under 10 MB).
MOST_SOURCES = 50_000


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; the others go. Null and empty texts are judged like any other, repeated rows alike;
    an empty table stays empty. Columns that are not of documents are left out, here and in the next stages."""
    scored = quality_classifier.score_quality(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where(F.col("score") >= quality_classifier.ACCEPT).select(*COLUMNS)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest doc_id (one without an id only if none has one).

    Texts without words all stay. Rows are told apart by doc_id and text: of rows that repeat a doc_id with unlike texts each
    stands for itself, and of rows that repeat both one stays. Texts are not shuffled while the rows that go are few.
    """
    docs = docs.select(*COLUMNS)
    hashed = jaccard_join.hashed(docs)
    rows, roots = jaccard_join.component_keys(hashed.select("doc_id", "th", "text"), NEAR_WORDS, NEAR_NUM, NEAR_DEN)
    rank = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "th")
    rows = rows.where("key IS NOT NULL").groupBy("key", "doc_id", "th").agg(F.count("*").alias("times"))
    grouped = rows.join(roots.select("key", "comp"), "key").withColumn("rank", rank)
    best = grouped.groupBy("comp").agg(F.min("rank").alias("best"))
    stays = F.col("rank").eqNullSafe(F.col("best"))
    found = materialise(grouped.join(best, "comp").select(F.col("doc_id").alias("of"), F.col("th").alias("hash"), "times", stays.alias("stays")), "near")
    same = lambda t: (hashed["th"] == t["hash"]) & hashed["doc_id"].eqNullSafe(t["of"])
    gone = jaccard_join._maybe_broadcast(materialise(found.where("NOT stays OR times > 1").select("of", "hash"), "gone"))
    left = hashed.join(gone, same(gone), "left_anti").select(*COLUMNS)
    twice = materialise(found.where("stays AND times > 1").select("of", "hash"), "twice")
    if twice.isEmpty():
        return left
    twice = jaccard_join._maybe_broadcast(twice)
    return left.unionByName(hashed.join(twice, same(twice), "left_semi").dropDuplicates(["doc_id", "th"]).select(*COLUMNS))


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [secrets.redact(t) for t in batch.column("text").to_pylist()]
        lengths = [n if t == old else len(t) for t, old, n in zip(texts, batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)]
        new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array(lengths, pa.int64())}
        yield pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in batch.schema.names], batch.schema.names)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; every secret found in a text is replaced by a mark, and n_chars follows."""
    return docs.select(*COLUMNS).mapInArrow(_redact, "doc_id long, text string, lang string, source string, n_chars long")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole copy: none, once or twice. Texts without words, which
    a mix takes no word of, go.

    What is taken of a source is a beginning of its shuffled order, for each time over; so a row per source, the ends of these,
    decides for every document, and no text is shuffled while sources are few.
    """
    docs = docs.select(*COLUMNS)
    mixed = mixing.mix(materialise(mixing.sized(docs), "mix-sizes"))
    copies = range(mixing.MOST_REPEATS)
    last = lambda e: F.max(F.when(2 * F.get("parts", F.lit(e)) >= F.col("size"), F.struct("shuffle", "size")))
    ends = materialise(mixed.where("size > 0").groupBy(F.col("source").alias("of")).agg(*(last(e).alias(f"end{e}") for e in copies)), "mix-ends")
    ends = F.broadcast(ends) if ends.count() <= MOST_SOURCES else ends
    own = docs.withColumn("__size", n_words()).where("__size > 0").withColumn("__at", F.struct(mixing.shuffle_key().alias("shuffle"), F.col("__size").alias("size")))
    taken = sum((F.coalesce((F.col("__at") <= F.col(f"end{e}")).cast("int"), F.lit(0)) for e in copies[1:]), F.coalesce((F.col("__at") <= F.col("end0")).cast("int"), F.lit(0)))
    kept = own.join(ends, F.col("source").eqNullSafe(F.col("of"))).withColumn("__n", taken).where("__n > 0")
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, their ids, and their places in sequences; the last stage, hence with columns of its own."""
    return packing.pack(docs, with_ids=True)
