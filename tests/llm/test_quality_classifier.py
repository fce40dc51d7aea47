import random
import zlib

import numpy as np

from locusweave.llm import quality_classifier as qc
from locusweave.llm import stages

RNG = random.Random(0)
PROSE = ["the", "cat", "sat", "on", "mat", "and", "of", "house", "river", "stone", "was", "to", "in", "bright", "evening", "walked"]


def document(good):
    words = [RNG.choice(PROSE) for _ in range(RNG.randint(20, 200))]
    return " ".join(words) if good else " ".join(w + RNG.choice(["***", "%%%", "&&&"]) for w in words)


def tables(spark, n=400):
    docs = [(i, document(i % 3 > 0), "en", f"s{i % 3}", 1, 0.5) for i in range(n)] + [(9001, None, None, None, None, 0.0), (9002, "", None, None, None, 0.0), (None, "a b", None, None, None, 0.0), (1, "x", None, None, None, 0.0)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(n)] + [(1, 1, 0), (9001, None, 0), (None, 1, 0), (77777, 1, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = tables(spark)
    got = qc.score_quality(docs, labels).select("doc_id", "text", "score", qc.held_out().alias("held")).collect()
    assert len(got) == 404 and all(0 <= r["score"] <= 1 for r in got)
    rest = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and r["text"] != "x"]
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rest)
    right = [(r["score"] >= 0.7) == (r["doc_id"] % 3 > 0) for r in rest if r["held"]]
    assert sum(right) / len(right) > 0.95


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = tables(spark, 120)
    changed = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "toxic")
    score = lambda l: sorted((str(r["doc_id"]), r["score"]) for r in qc.score_quality(docs, l).collect())  # noqa: E731, E741
    assert score(labels) == score(changed)


def test_long_text_is_scored_whole_and_columns_may_clash(spark):
    docs, labels = tables(spark, 120)
    good, bad = document(True), document(False)
    extra = spark.createDataFrame([(9100, " ".join([bad] * 3000), 7), (9101, " ".join([good] * 20 + [bad] * 3000), 7), (9102, bad, 7)], "doc_id long, text string, quality int")
    got = {r["doc_id"]: r["score"] for r in qc.score_quality(docs.select("doc_id", "text", qc.F.lit(5).alias("quality")).union(extra), labels).where("doc_id >= 9100").collect()}
    assert abs(got[9100] - got[9101]) < 0.2 and max(got.values()) < 0.7


def test_empty_tables(spark):
    docs, labels = tables(spark, 20)
    assert qc.score_quality(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in qc.score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_temperature_and_gradient():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] + 0.5 * rng.normal(size=600) > 0).astype(int)
    net = qc.fit(x, y)
    assert 0.5 <= net.temperature <= 8
    assert ((net.score(x) > 0.5) == y).mean() > 0.8


def test_contexts_match_a_plain_count():
    texts = ["a b c a", None, "b", "", "c c  b\na"]
    index, total = qc.index_vectors(qc.ROWS, 1), np.zeros((qc.ROWS, qc.DIM))
    qc.contexts(texts, total, index)
    want = np.zeros_like(total)
    for t in texts:
        rows = qc.word_rows(qc.word_hashes([(t or "").encode()])[0])
        for i in range(len(rows)):
            for j in range(max(0, i - qc.REACH), min(len(rows), i + qc.REACH + 1)):
                if i != j:
                    want[rows[i]] += index[rows[j]]
    assert np.allclose(total, want)


def test_stage_drops_what_is_rejected(spark, tmp_path):
    docs, labels = tables(spark)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = stages.keep_good(spark, docs.where("doc_id < 400 AND text <> 'x'"), str(tmp_path))
    assert kept.columns == list(stages.COLUMNS)
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & {i for i in range(400) if i % 3 == 0}) < 8 and len(ids & {i for i in range(400) if i % 3}) > 255
