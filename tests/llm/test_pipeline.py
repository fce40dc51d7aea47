import collections
import zlib

import numpy as np

import corpus_pipeline
from locusweave.llm import packing, secrets, stages
from locusweave.llm.common import exclusive_prefix, materialise

from .test_quality_classifier import document

KEY = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"


def test_prefix_sums_split_a_group(spark):
    rows = [(g, i * 7 % 100, i) for g in "ab" for i in range(100)]
    df = spark.createDataFrame(rows, "g string, o int, v int").selectExpr("*", "o div 9 AS bucket")
    got = {(r["g"], r["o"]): r["before"] for r in exclusive_prefix(df, ["g"], "bucket", ["o"], {"before": "v"}).collect()}
    for g in "ab":
        total = 0
        for o, v in sorted((o, v) for k, o, v in rows if k == g):
            assert got[g, o] == total
            total += v


def test_stages_one_after_the_other(spark, tmp_path):
    docs = [(i, document(i % 5 > 0), "en", f"s{i % 4}", 1) for i in range(200)]
    base = " ".join(f"word{i} the and of" for i in range(60))
    docs += [(500 + i, base, "en", "s1", 1) for i in range(20)] + [(600, base.replace("word3 ", "changed "), "en", None, 1), (700, f"{document(True)} secret={KEY} {document(True)}", "en", "s2", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "secret_scans", "mixing", "packing"]
    now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        now = materialise(stage(spark, now, str(tmp_path)), name)
        seen.append(now)
        assert name == "packing" or now.columns == list(stages.COLUMNS)
    good, single, clean, mixed, packed = ([r.asDict() for r in s.collect()] for s in seen)
    assert len({r["doc_id"] for r in good} & {i for i in range(200) if i % 5 == 0}) < 5
    kept = [r["doc_id"] for r in single]
    assert len(kept) == len(set(kept)) and sum(d >= 500 and d <= 600 for d in kept) == (1 if any(500 <= r["doc_id"] <= 600 for r in good) else 0)
    assert sorted(kept) == sorted(r["doc_id"] for r in clean)
    assert not any(secrets.scan(r["text"])[0] for r in clean)
    assert max(collections.Counter(r["doc_id"] for r in mixed).values()) <= 2
    copies, tokens = collections.Counter(r["doc_id"] for r in mixed), packing.Tokens()
    total = sum(len(tokens(r["text"])) // 4 + 1 for r in mixed)
    assert sum(r["length"] for r in packed) == total and {r["doc_id"] for r in packed} == set(copies)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in packed)
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, again)) == sorted(tuple(r.values()) for r in packed)


def test_stages_take_null_texts_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    odd = [(1, None, None, None, None, 1), (2, "", "en", None, 0, 1), (None, "a b c", "en", "s", 5, 1), (3, "a b c", "en", "s", 5, 1)]
    for rows in (odd, []):
        now = spark.createDataFrame(rows, schema)
        assert stages.hide_secrets(spark, now, "").count() == len(rows)
        single = stages.keep_one_of_near(spark, now, "")
        assert single.columns == list(stages.COLUMNS) and sorted(r["doc_id"] for r in single.collect()) == ([1, 2, 3] if rows else [])
        assert {r["doc_id"] for r in stages.mix_sources(spark, now, "").collect()} <= {None, 3}
        assert stages.pack_windows(spark, now, "").agg({"length": "sum"}).first()[0] == (sum(1 if not r[1] else 4 for r in rows) or None)
        assert stages.keep_good(spark, now, str(tmp_path)).count() <= len(rows)
