import hashlib
import math
import random
import re
import zlib

import numpy as np

from locusweave.llm import importance


def grams(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, share=5):
    s, t = [0] * 10000, [0] * 10000
    for texts, out in (([x for _, x in docs], s), (target, t)):
        for x in texts:
            for b in grams(x)[1]:
                out[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    rows = []
    for i, x in docs:
        n, bs = grams(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in bs)
        rows.append([i, len(bs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(fit[: share * len(fit) // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in rows]


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    pool = ["The", "été", "cat's", "x1", "Ünder", "日本", "a" * 60, "b" * 49, "c" * 48, "dog", "\u00a0", "ok-go", "E.T.", "9"] + [f"w{k}" for k in range(60)]
    text = lambda: rng.choice([" ", "\n", "  ", ", "]).join(rng.choice(pool) for _ in range(rng.randrange(60)))
    docs = [(i, text()) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, "\x00 \x7f"), (n + 3, "z" * 100_000), (None, "the " * 30), (5, "dog " * 25), (5, "dog " * 25)]
    return docs, [text() for _ in range(20)] + [None, ""]


def test_against_brute_force(spark, monkeypatch):
    docs, target = corpus()
    frame = spark.createDataFrame([(i, x, 1, 2) for i, x in docs], "doc_id long, text string, score int, rank int")
    goal = spark.createDataFrame([(x,) for x in target], "text string")
    key = lambda r: tuple((x is None, x) for x in r)
    for stripe in (1_000_000, 3):
        monkeypatch.setattr(importance, "STRIPE", stripe)
        for share in (5, 60, 100):
            got = [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in importance.resample(frame, goal, share).collect()]
            assert sorted(got, key=key) == sorted(brute(docs, target, share), key=key)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert importance.resample(docs.limit(0), docs).collect() == []
    row = importance.resample(docs, docs.limit(0)).first()
    assert row["rank"] is None and row["n_features"] == 117


def test_features_stay_within_texts():
    texts = [b"a b", b"", b"c", b"d e f g"]
    bucket, owner, words = importance.features(texts)
    assert np.bincount(owner, minlength=4).tolist() == [3, 0, 1, 9] and words.tolist() == [2, 0, 1, 4]
    assert sorted(bucket[owner == 3].tolist()) == sorted(grams("d e f g")[1])
    assert [len(x) for x in importance.features([])] == [0, 0, 0]
