import random
import re
from collections import Counter

import numpy as np
import pytest

from locusweave.llm import phrases, trie


def brute(docs, least, share=80, most=2000):
    n, f = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, ws), a in cand.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                longer[lang, ws[i : i + k]] = max(longer[lang, ws[i : i + k]], a)
    rows = {}
    for (lang, ws), a in cand.items():
        if longer[lang, ws] and 100 * longer[lang, ws] >= share * a:
            continue
        score, _, left, right = min((2000000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]]) for k in range(1, len(ws)))
        rows.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), left, right))
    return sorted((lang, k, p.decode(), -a, x, y, n[lang], -s) for lang, got in rows.items() for k, (s, a, p, x, y) in enumerate(sorted(got)[:most], 1))


def corpus(seed):
    rng = random.Random(seed)
    pool = ["the", "The", "of", "a", "é", "日本", " ", "x" * 70, "b-c", "\x00", "ok"] + [f"w{k}" for k in range(25)]
    gap = lambda: rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"])
    text = lambda n: "".join(rng.choice(pool) + gap() for _ in range(rng.randrange(n)))
    docs = [(rng.choice(["en", "de", None, "und", ""]), text(60)) for _ in range(120)]
    docs += [("en", "one two three four five. " * 3)] * 15 + [("de", None), ("de", ""), (None, " \t. "), ("en", "solo"), ("fr", "lonely words")]
    return docs + [("en", text(4000))]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    docs, frames = corpus(small), 1
    if small:  # many tries, slabs and blocks
        monkeypatch.setattr(phrases, "SLICE", 40)
        frames = 7
    frame = spark.createDataFrame([(i, lang, text, 1, "r") for i, (lang, text) in enumerate(docs)], "doc_id long, lang string, text string, n int, rank string").repartition(frames)
    for least, most in ((4, 2000), (9, 20)):
        got = phrases.mine(frame, least, most=most).collect()
        assert sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got) == brute(docs, least, most=most)


def test_empty_table_and_no_candidate(spark):
    frame = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    assert phrases.mine(frame.limit(0)).collect() == []
    assert phrases.mine(frame).collect() == []


def test_blocks_do_not_change_counts(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 5)
    counts, got = phrases._Counts(), Counter()
    for k in range(9):
        for a, b, n in counts.add(np.array([1, 2, 2, 1]), np.array([k % 2, 0, 0, 1])):
            got.update(dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)))
    # a row twice in one flush would overwrite, and all rows of both are counted
    for a, b, n in counts.flush():
        got.update(dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)))
    assert got == {(1, 0): 5, (1, 1): 13, (2, 0): 18}


@pytest.mark.parametrize("words", [1, 2, 5, 300, 70_000])
def test_trie_knows_its_phrases_only(words):
    rng = np.random.default_rng(words)
    heads = rng.integers(0, words, 5)
    rows = []
    for _ in range(3000):
        size = rng.integers(2, 5)
        row = rng.integers(0, words, size)
        row[0] = rng.choice(heads) if rng.random() < 0.5 else row[0]
        rows.append([*row.tolist(), *[-1] * (4 - size)])
    rows = np.unique(np.array(rows), axis=0)
    t, digits = trie.build(rows, words), trie.digits_of(words)
    others = rng.integers(0, words, (5000, 4))
    for given in (rows, others):
        known = {tuple(x for x in r if x >= 0): i for i, r in enumerate(rows.tolist())}
        at, states = np.arange(len(given)), given[:, 0]
        for level in range(1, 4):
            on = given[at, level] >= 0
            at, states = at[on], states[on]
            alive, states = trie.step(t, states, given[at, level], digits)
            at = at[alive]
            found = dict(zip(at.tolist(), t["accept"][states].tolist(), strict=True))
            for i, r in enumerate(given[:, : level + 1].tolist()):
                if -1 not in r:
                    assert found.get(i, -1) == known.get(tuple(r), -1)
