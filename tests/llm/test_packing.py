import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from locusweave.llm import packing

WORDS = ["the", "cat", "Überraschung", "naïve", "1234", "don't", "\n", "\t", "  ", "😀", "<|endoftext|>", "x" * 40]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts(seed, n):
    rng = random.Random(seed)
    return [None, "", " ", "a"] + [" ".join(rng.choices(WORDS, k=rng.choice([1, 5, 60, 400, 900, 1500]))) for _ in range(n)]


def test_ids_equal_those_of_tokenizers(tokenizer):
    tokens = packing.Tokens()
    for t in texts(1, 60)[1:]:
        assert tokens(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_every_id_lies_in_one_piece_and_nothing_is_padded(spark, tokenizer):
    rows = list(enumerate(texts(2, 120)))
    rows += [rows[9], (None, "null id")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, length int")
    got = packing.pack(docs).collect()
    again = packing.pack(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in rows}
    for d, x in ids.items():
        copies = 2 if d == rows[9][0] else 1
        pieces = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got if r["doc_id"] == d)
        covered = np.zeros(len(x), int)
        for start, length, crc, n in pieces:
            assert n == len(x) and crc == zlib.crc32(x[start : start + length].tobytes())
            covered[start : start + length] += 1
        assert (covered == copies).all()
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.pack(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_each_remainder_at_most_once(seed):
    rng = np.random.default_rng(seed)
    have = rng.poisson([0.3, 2, 40, 0][seed], 2048)
    have[0] = 0
    goal = packing.plan(have)
    assert (goal.planned <= have).all() and (goal.planned >= 0).all()
    used = {}
    for ell in np.flatnonzero(goal.planned):
        seq, off = goal.place(np.full(goal.planned[ell], ell), np.arange(goal.planned[ell]))
        for s, o in zip(seq.tolist(), off.tolist(), strict=True):
            used.setdefault(s, []).append((o, int(ell)))
    assert len(used) == goal.windows
    for parts in used.values():
        at = 0
        for o, ell in sorted(parts):
            assert o == at
            at += ell
        assert at == 2048
    if seed == 2:
        assert goal.planned.sum() > 0.95 * have.sum()


def test_solution_is_near_the_least_squares_one():
    have = np.zeros(2048)
    have[[100, 1948, 700, 648]] = [5, 3, 4, 2]
    x = packing.solve(packing.combinations(), have, 400)
    assert (x >= 0).all()
    combos = packing.combinations()
    ahead = sum(np.bincount(combos[:, k], x, 2048) for k in range(3))
    ahead[0] = 0
    # 100 + 1948, and 700 + 700 + 648: least squares by hand
    assert abs(x.sum() - (4 + 2)) < 0.05
    assert ((ahead - have) ** 2).sum() < 2.01
