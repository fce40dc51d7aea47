import collections
import math
import random
import zlib

import numpy as np
import pytest

from locusweave.llm import language_model as lm

SCHEMA = "doc_id long, text string, held_out boolean, score int"


def corpus(n=300):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        words, w = [], rng.randrange(20)
        for _ in range(rng.choice([0, 1, 5, 40, 120])):
            w = (3 * w + rng.choice([1, 1, 1, 7])) % 20
            words.append(f"W{w}" if rng.random() < 0.9 else f"rare{rng.randrange(400)}")
        rows.append((i, " ".join(words)))
    return rows + [(5, rows[5][1]), (1000, None), (None, "w1 w2"), (1001, " \t\n"), (1002, "w3 " * 5000)]


def held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0


def brute(rows):
    tokens = [((t or "").encode().lower().split() + [None]) for _, t in rows]
    count = collections.Counter(x for (d, _), t in zip(rows, tokens, strict=True) if not held(d) for x in t)
    n, v = sum(count.values()), len(count)
    return [(len(t), sum(count[x] > 0 for x in t), n, sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)) for t in tokens]


@pytest.mark.parametrize("head", [500_000, 30, 0])
def test_base_and_model(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    monkeypatch.setattr(lm, "ONE_OF", 2)
    rows = corpus()
    docs = spark.createDataFrame([(d, t, held(d), 1) for d, t in rows], SCHEMA).repartition(3)
    got = lm.score_documents(docs).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got), key=key) == sorted(
        ((d, held(d), n, k, total, round(base, 5)) for (d, _), (n, k, total, base) in zip(rows, brute(rows), strict=True)), key=key
    )
    assert all(r["score"] < 0 for r in got)
    if head > 100:
        out = [r for r in got if r["held_out"]]
        assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_held_out_follows_the_crc(spark):
    docs = spark.createDataFrame([(d,) for d in [*range(200), None]], "doc_id long").select("doc_id", lm.held_out().alias("h"))
    assert all(r["h"] == held(r["doc_id"]) for r in docs.collect())


def test_empty_and_untrained(spark):
    assert lm.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    got = lm.score_documents(spark.createDataFrame([(1, "a b", True, 0)], SCHEMA)).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(3, 0, 0)]


def weights(seed=0):
    rng = np.random.default_rng(seed)
    return {k: rng.normal(0, 0.3, s) for k, s in lm.SHAPES.items()}


def test_probabilities_add_up_and_gradients_are_right():
    w = weights()
    h = np.random.default_rng(1).normal(size=(1, lm.HIDDEN))
    every = lm.log_probability(w, np.repeat(h, lm.VOCABULARY, 0), np.arange(lm.VOCABULARY))[0]
    assert abs(np.exp(every).sum() - 1) < 1e-9
    states, place = np.random.default_rng(2).normal(size=(6, lm.HIDDEN)), np.array([3, 40, 41, 999, 3, 5000])
    g = {k: np.zeros_like(x) for k, x in w.items()}
    _, back = lm.log_probability(w, states, place, g)
    loss = lambda: -lm.log_probability(w, states, place)[0].sum()
    for name, at in (("class", (2, 1)), ("class", (0, lm.HIDDEN)), ("word", (41, 8)), ("word", (999, lm.HIDDEN))):
        old = w[name][at]
        w[name][at] = old + 1e-5
        up = loss()
        w[name][at] = old - 1e-5
        down = loss()
        w[name][at] = old
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-5
    states[2, 4] += 1e-5
    up = loss()
    states[2, 4] -= 2e-5
    assert abs((up - loss()) / 2e-5 - back[2, 4]) < 1e-5


def test_gradients_run_back_through_the_steps():
    rng = np.random.default_rng(7)
    w, place = weights(7), np.arange(lm.VOCABULARY)
    doc = rng.integers(0, 300, lm.STEPS - 1)
    kept = {}
    trainer = lm.Trainer(w)
    trainer.update = lambda size, used: kept.update({k: g.copy() for k, g in trainer.grads.items()})
    trainer.train([doc], place)
    loss = lambda: -lm.score_ids(w, [doc], place)[0]
    for name, at in (("embed", (int(doc[3]), 2)), ("input", (1, 5)), ("input", (2, lm.HIDDEN + 3)), ("state", (4, 2 * lm.HIDDEN + 1)), ("state", (3, 2)), ("bias", (2 * lm.HIDDEN,))):
        old = w[name][at]
        w[name][at] = old + 1e-3
        up = loss()
        w[name][at] = old - 1e-3
        down = loss()
        w[name][at] = old
        assert abs((up - down) / 2e-3 - kept[name][at]) < 1e-2 * max(1, abs(kept[name][at])), name


def test_states_run_on_over_windows(monkeypatch):
    w, place = weights(), np.arange(lm.VOCABULARY)
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, lm.VOCABULARY, n) for n in (0, 1, 7, 64, 65, 200, 3)]
    got = lm.score_ids(w, docs, place)
    monkeypatch.setattr(lm, "WINDOW", 5)
    monkeypatch.setattr(lm, "WIDE", 2)
    assert np.allclose(got, lm.score_ids(w, docs, place))
    for d, total in zip(docs, got, strict=True):
        h, last, want = np.zeros((1, lm.HIDDEN)), lm.END, 0.0
        for x in [*d, lm.END]:
            h, _ = lm.step(w, w["embed"][[last]] @ w["input"] + w["bias"], h)
            want += lm.log_probability(w, h, place[[x]])[0][0]
            last = x
        assert abs(want - total) < 1e-3 + 1e-4 * abs(want)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(4)
    docs = [np.cumsum(np.ones(60, int)) * 3 % 17 + 2 + rng.integers(0, 2) for _ in range(120)]
    unigram = np.bincount(np.concatenate(docs), minlength=lm.VOCABULARY) + 0.1
    w, place = lm.start(unigram / unigram.sum()), lm.place_of(unigram)
    before = lm.score_ids(w, docs[:10], place).sum()
    trainer = lm.Trainer(w)
    for _ in range(4):
        trainer.train(docs, place)
    assert trainer.seen == 4 * sum(len(d) + 1 for d in docs) and lm.score_ids(w, docs[:10], place).sum() > before + 100
    assert all(np.array_equal(a, b) for a, b in zip(lm.unpack_weights(lm.pack_weights(w)).values(), w.values(), strict=True))


def test_every_training_document_reaches_the_network_once(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 5000)
    rounds = []
    real = lm._average
    monkeypatch.setattr(lm, "_average", lambda t: rounds.append(sum(t.column("tokens").to_pylist())) or real(t))
    monkeypatch.setattr(lm, "FAN_IN", 100)
    docs = spark.createDataFrame([(i, f"a{i % 7} b c " * 40) for i in range(400)], "doc_id long, text string").repartition(2)
    lm.fit(docs, lm.Head(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), 400 * 121, 1, 1, np.full(lm.VOCABULARY, 1 / lm.VOCABULARY)))
    assert len(rounds) == 2 and sum(rounds) == 400 * 121


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 1500)
    monkeypatch.setattr(lm, "FAN_IN", 2)
    docs = spark.createDataFrame([(d, t, held(d), 1) for d, t in corpus()], SCHEMA)
    one, two = (sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm.score_documents(docs.repartition(n)).collect()) for n in (2, 5))
    assert len(one) == len(two) and all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 * max(1, abs(a[2])) for a, b in zip(one, two, strict=True))


def test_portions_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(lm, "ROWS", 3)
    monkeypatch.setattr(lm, "SIZE", 10)
    texts = ["a" * n for n in (1, 2, 3, 4, 50, 1, 9, 2, 0, 0, 0, 0)]
    batch = lm.pa.RecordBatch.from_arrays([lm.pa.array(texts), lm.pa.array([0] * 7 + [1] * 5)], ["text", "shard"])
    parts = [p.column("text").to_pylist() for p in lm.portions([batch])]
    assert sum(parts, []) == texts
    assert all(len(p) == 1 or len(p) <= 3 and sum(map(len, p)) <= 10 for p in parts)
    runs = list(lm._rows_of([batch]))
    assert sum((p for _, p in runs), []) == texts and [k for k, _ in runs] == sorted(k for k, _ in runs)
    assert all(len(p) == 1 or len(p) <= 3 and sum(map(len, p)) <= 10 for _, p in runs)


def test_texts_are_looked_up_once_and_trained_from_ids(spark):
    words = [f"w{k}" for k in range(50)]
    hashes = np.sort(lm.word_hashes([" ".join(words).encode()])[0])
    head = lm.Head(hashes, np.full(50, 7, np.int64), np.arange(2, 52, dtype=np.int32), 1000, 51, 3, np.full(lm.VOCABULARY, 1 / lm.VOCABULARY))
    texts = ["w3 W4 never w3", "", None, "w9 " * 70_000, "x y x"]
    docs = spark.createDataFrame([(i, t, i == 4) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean").repartition(3)
    parts = {r["doc_id"]: r for r in lm.encode(docs.selectExpr("doc_id", "coalesce(text, '') AS text", "held_out"), head).collect()}
    assert "text" not in parts[0].asDict() and len({r["row"] for r in parts.values()}) == 5
    for i, t in enumerate(texts):
        want = head.find(lm.word_hashes([(t or "").encode()])[0])[0]
        assert lm.ids_of(bytes(parts[i]["ids"])).tolist() == want.tolist() and parts[i]["n_tokens"] == len(want) + 1
        assert len(parts[i]["ids"]) == 2 * len(want)
    assert [parts[i]["held_out"] for i in range(5)] == [False] * 4 + [True]
    assert sorted(x["n"] for x in parts[4]["tail"]) == [1, 2] and [x["n"] for x in parts[0]["tail"]] == [1]


def test_the_softmax_is_narrow_for_frequent_words():
    p = 1 / np.arange(1, lm.VOCABULARY + 1)
    p[0], width = 3.0, np.diff(lm.FIRST)[lm.CLASS_OF]
    mean = float((p / p.sum() * width).sum())
    levels = [len(lm.start(p / p.sum())[k]) for k in ("group", "class")]
    assert levels == [lm.GROUPS, lm.CLASSES] and lm.GROUPS + lm.GROUP + mean < 125  # 231 with two levels
    every = lm.log_probability({k: x.astype(np.float64) for k, x in lm.start(p / p.sum()).items()}, np.zeros((lm.VOCABULARY, lm.HIDDEN)), lm.place_of(p))[0]
    assert np.allclose(np.exp(every), p / p.sum(), rtol=1e-4)


def test_models_are_added_up_without_a_shuffle_in_any_order(spark, monkeypatch):
    rng = np.random.default_rng(4)
    models = [({k: rng.normal(0, 1, x).astype(np.float32) for k, x in lm.SHAPES.items()}, int(rng.integers(1, 1 << 22))) for _ in range(5)]
    rows = [(n, lm.pack_weights(w), None) for w, n in models]
    table = lambda rows: lm.pa.table({"tokens": [r[0] for r in rows], "weights": lm.pa.array([r[1] for r in rows], lm.pa.binary()), "sums": lm.pa.array([r[2] for r in rows], lm.pa.binary())})
    want = sum(np.frombuffer(r[1], np.float32) * float(r[0]) for r in rows) / sum(r[0] for r in rows)
    got = lm._average(table(rows))
    assert np.abs(np.frombuffer(got, np.float32) - want).max() < 2e-6
    parts = [next(lm._add_up(table(p).to_batches())) for p in (rows[3:], rows[:1], rows[1:3])]
    assert lm._average(lm.pa.Table.from_batches(parts)) == got
    monkeypatch.setattr(lm, "SHARD_TOKENS", 3000)
    monkeypatch.setattr(lm, "FAN_IN", 2)
    plans, real = [], lm.materialise
    monkeypatch.setattr(lm, "materialise", lambda df, what: plans.append((what, df._jdf.queryExecution().toString())) or real(df, what))
    docs = spark.createDataFrame([(i, f"a{i % 7} b c " * 40) for i in range(200)], "doc_id long, text string").repartition(2)
    lm.fit(docs, lm.Head(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), 200 * 121, 1, 1, np.full(lm.VOCABULARY, 1 / lm.VOCABULARY)))
    sums = [p for what, p in plans if what == "models" and "_add_up" in p]
    assert len(sums) >= 2 and not any("Exchange" in p for p in sums)


def test_words_of_the_head_are_found_by_their_first_bits():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3000):
        every = np.unique(np.concatenate([rng.integers(0, 1 << 64, 2 * n, dtype=np.uint64), np.arange(40, dtype=np.uint64), ~np.arange(40, dtype=np.uint64)]))
        words = np.sort(rng.permutation(every)[:n])
        got = lm.Head(words, np.ones(n, int), np.full(n, 1, np.int32), 1, 1, 1, np.ones(1)).index(every)
        assert np.array_equal(np.append(words, 0)[got] == every, np.isin(every, words) | (every == 0) & (got == n)) and np.array_equal(got < n, np.isin(every, words))


def test_few_rows_of_many_classes_are_one_product(monkeypatch):
    w, rng = weights(), np.random.default_rng(6)
    place, h = rng.integers(0, lm.VOCABULARY, 5000), rng.normal(size=(5000, lm.HIDDEN))
    place[:2000] = 3
    calls, real = [], lm._softmax
    monkeypatch.setattr(lm, "_softmax", lambda *a: calls.append(1) or real(*a))

    def run():
        g = {k: np.zeros_like(x) for k, x in w.items()}
        return (*lm.log_probability(w, h, place, g), g)

    got, calls_once = run(), len(calls)
    monkeypatch.setattr(lm, "CELLS_AT_ONCE", 0)
    want = run()
    assert calls_once < 40 and len(calls) - calls_once > 200
    assert np.allclose(got[0], want[0]) and np.allclose(got[1], want[1]) and all(np.allclose(got[2][k], want[2][k]) for k in w)


def test_long_documents_share_their_steps(monkeypatch):
    rng, calls, real = np.random.default_rng(9), [], lm.step
    w = {k: x.astype(np.float32) for k, x in weights(9).items()}
    unigram = np.arange(lm.VOCABULARY, 0, -1.0)
    docs = [rng.integers(0, lm.VOCABULARY, n) for _ in range(4) for n in (1500, 0, 3, 200, 1)]
    batches = [lm.pa.RecordBatch.from_arrays([lm.pa.array(range(k, k + 5)), lm.pa.array([d.astype("<u2").tobytes() for d in docs[k : k + 5]], lm.pa.binary())], ["row", "ids"]) for k in range(0, 20, 5)]
    monkeypatch.setattr(lm, "step", lambda *a: calls.append(1) or real(*a))
    got = [b.to_pydict() for b in lm._score(unigram, lm.pack_weights(w))(batches)]
    assert sum((b["row"] for b in got), []) == list(range(20)) and 1501 <= len(calls) < 2000  # 6004 with each batch by itself
    alone = [lm.score_ids(w, [d], lm.place_of(unigram))[0] / math.log(10) for d in docs]
    assert np.allclose(sum((b["model"] for b in got), []), alone, rtol=1e-5)
