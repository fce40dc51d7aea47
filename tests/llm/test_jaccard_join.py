import random

import numpy as np
import pytest

from locusweave.llm import common, graph, jaccard_join, stages
from locusweave.llm.hashing import shingle_sets


def shingles(text, n=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute(rows, n=3, num=90, den=100):
    """Components over all linked pairs; texts without words alone."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, n=160):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 3)
    shared = [word() for _ in range(60)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.5 or not texts:
            texts.append([word() for _ in range(rng.choice([0, 1, 2, 3, 8, 25, 60, 200]))] + (shared if rng.random() < 0.3 else []))
        else:
            copy = list(rng.choice(texts))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                if copy:
                    copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    return [(i, rng.choice([" ", "\n", "  "]).join(t).upper() if rng.random() < 0.2 else " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "split", "side", "small"), [(1, 4096, 512, 300_000), (2, 5, 2, 0)])
def test_against_all_pairs(spark, monkeypatch, seed, split, side, small):
    for name, value in (("SPLIT", split), ("SIDE", side), ("SMALL", small), ("BUCKET_BYTES", 2000), ("SAMPLE", 4096 if seed == 1 else 40)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = corpus(seed)
    got = jaccard_join.near_components(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int"))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(7, None), (8, ""), (9, " \t\n"), (3, "a b"), (2, "A  b"), (5, text), (5, text), (4, text.upper()), (None, text), (None, "q r s t"), (5, "q r s t u v"), (6, "a b c" + " d")]
    schema = "doc_id long, text string"
    got = sorted((tuple(r) for r in jaccard_join.near_components(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(7, 0, 7), (8, 0, 8), (9, 0, 9), (3, 1, 2), (2, 1, 2), (5, 48, 4), (5, 48, 4), (4, 48, 4), (None, 48, 4), (None, 2, None), (6, 1, 6), (5, 4, 5)], key=str)
    assert jaccard_join.near_components(spark.createDataFrame([], schema)).collect() == []


def test_links_run_through_rows_without_an_id(spark):
    words = [f"w{i}" for i in range(120)]
    texts = [words[:100], words[3:103], words[6:106]]  # 95 / 101 between neighbours, 92 / 104 between the ends
    rows = [(1, " ".join(texts[0])), (None, " ".join(texts[1])), (2, " ".join(texts[2]))]
    got = jaccard_join.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, None: 1, 2: 1}


def test_very_long_texts(spark):
    words = [f"word{i}" for i in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:280_000])), (3, " ".join(words[:200_000])), (4, "x" * 3_000_000)]
    got = jaccard_join.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {(1, 299_998, 1), (2, 279_998, 1), (3, 199_998, 3), (4, 1, 4)}


def test_partners_lie_in_a_common_region():
    rng = np.random.default_rng(5)
    for num in (80, 90):
        sets = [np.unique(rng.integers(1, 400, int(rng.integers(3, 200)))).astype(np.uint64) for _ in range(80)]
        pivots, _ = jaccard_join.choose(sets, num, 100)
        some = jaccard_join.Pivots.of(sets[:12], num, 100)
        for s in sets:
            t = np.unique(np.concatenate([s[int(rng.integers(0, 1 + len(s) // 6)) :], rng.integers(400, 500, int(rng.integers(0, 1 + len(s) // 20))).astype(np.uint64)]))
            both = len(np.intersect1d(s, t))
            if 100 * both >= num * (len(s) + len(t) - both):
                for p in (pivots, some):
                    assert np.intersect1d(p.regions(s)[0], p.regions(t)[0]).size


def test_sql_agrees(spark, tmp_path):
    import duckdb

    docs = spark.createDataFrame(corpus(6, 90), "doc_id long, text string")
    docs.toPandas().to_parquet(tmp_path / "d.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet'")
    assert sorted(con.sql(jaccard_join.SQL).fetchall()) == sorted(tuple(r) for r in jaccard_join.near_components(docs).collect())


def test_tiles_meet_all_but_sets_of_one_pivot(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SIDE", 3)
    rng = random.Random(9)
    rows = [(r, 100 * r + k, rng.choice([None, None, 1, 2]) if r else 7, rng.randrange(1, 9)) for r in range(4) for k in range([20, 5, 30, 1][r])]
    dealt = jaccard_join._tiles(spark.createDataFrame(rows, "region long, key long, core long, n_shingles long")).collect()
    tiles = {}
    for d in dealt:
        tiles.setdefault((d["region"], d["i"], d["j"]), set()).add(d["key"])
    assert all(r for r, _, _ in tiles) and max(map(len, tiles.values())) <= 30
    for r, a, c, _ in rows:
        for q, b, e, _ in rows:
            if r == q and r and a < b and (c is None or c != e):
                assert any(t[0] == r and {a, b} <= keys for t, keys in tiles.items())


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100)])
def test_linked_sets_share_a_cell(num, den):
    rng = np.random.default_rng(num)
    slicer = jaccard_join.Slicer(num, den)
    for _ in range(400):
        n = int(rng.integers(2, 300))
        pool = rng.integers(1, 1 << 63, 2 * n + 2).astype(np.uint64)
        a = np.unique(pool[:n])
        drop = int(rng.integers(0, max(1, n * (den - num) // den) + 1))
        b = np.unique(np.concatenate([a[drop:], pool[n : n + int(rng.integers(0, 1 + n * (den - num) // den))]]))
        both = len(np.intersect1d(a, b))
        if len(b) and den * both >= num * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert np.intersect1d(slicer.cells(a), slicer.cells(b)).size


def test_large_and_small_tiles_agree():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(30)) for _ in range(20)]
    texts += [t + " z" for t in texts for _ in range(2)] + [t[2:] for t in texts]
    sets = [s for s in shingle_sets(texts, 3)]
    links = jaccard_join.links_within(sets, 90, 100)
    rows = list(enumerate(texts))
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    assert [root[i] for i, _ in rows] == [c for _, _, c in brute(rows)]


def test_stage_keeps_one_of_each_group(spark):
    texts = corpus(4, 80)
    rows = [(i, t, "en", "s", len(t)) for i, t in texts]
    other = " ".join(f"q{i}" for i in range(40))
    extra = [(0, texts[0][1], "en", "s", 1), (None, "x y z", None, None, None), (None, "x Y z", None, None, None), (3, other, "en", "s", 1), (900, other + " r", "en", "s", 1)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"]) for r in stages.keep_one_of_near(spark, docs, "").collect()]
    want = {(c, dict(texts)[c]) for _, _, c in brute(texts, 5, 80, 100)} | {(3, other)}  # an unlike text with the same id stays
    assert sorted(k for k in kept if k[0] is not None) == sorted(want)
    assert len([k for k in kept if k[0] is None]) == 1


def test_stage_drops_what_five_words_at_four_fifths_link(spark):
    words = [f"w{i}" for i in range(200)]
    changed = ["x" if i in (30, 70) else w for i, w in enumerate(words[:100])]  # 86 / 106 by five words, 92 / 104 by three
    longer = words[:90] + [f"y{i}" for i in range(20)] + words[90:]  # 192 / 220
    other = ["z" if i % 10 == 5 else w for i, w in enumerate(words[:100])]  # far below
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate([words[:100], changed, other, words[100:] + words[:100], longer[::-1], words[::-1]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in stages.keep_one_of_near(spark, docs, "").collect()) == [0, 2, 3, 4]
    rows = [(i, t, "en", "s", len(t)) for i, t in corpus(4, 80)]
    kept = stages.keep_one_of_near(spark, spark.createDataFrame(rows, docs.schema), "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, _, c in brute(corpus(4, 80), 5, 80, 100)})


@pytest.mark.parametrize("num", [80, 90])
def test_linked_sets_share_a_cell_whatever_is_common(num):
    rng = np.random.default_rng(num)
    for _ in range(300):
        n = int(rng.integers(2, 400))
        pool = np.unique(rng.integers(1, 1 << 63, 2 * n + 2).astype(np.uint64))
        slicer = jaccard_join.Slicer(num, 100, np.sort(rng.choice(pool, int(len(pool) * rng.random()), replace=False)))
        rng.shuffle(pool)
        a = np.sort(pool[:n])
        b = np.sort(np.concatenate([pool[int(rng.integers(0, 1 + n * (100 - num) // 100)) : n], pool[n : n + int(rng.integers(0, 1 + n * (100 - num) // 200))]]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= num * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert np.intersect1d(slicer.cells(a), slicer.cells(b)).size


def test_common_passages_do_not_join_texts(spark):
    rng = random.Random(8)
    shared = [[f"c{k}_{i}" for i in range(12)] for k in range(6)]
    texts = [" ".join(sum([[f"t{d}_{p}_{i}" for i in range(14)] + rng.choice(shared) for p in range(4)], [])) for d in range(300)]
    sets = list(shingle_sets(texts, 5))
    pivots, common = jaccard_join._sampled(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 300, 5, 80, 100)
    assert len(common) >= 48 and 1 <= len(pivots.sizes) <= jaccard_join.PIVOTS
    slicer = jaccard_join.Slicer(80, 100, common)
    _, n = np.unique(np.concatenate([np.unique(slicer.cells(s)) for s in sets]), return_counts=True)
    assert (n > 1).sum() < 5


def test_small_tables_are_few_files_whatever_the_partitions(spark, monkeypatch, tmp_path):
    paths = []
    monkeypatch.setattr(common, "fresh_path", lambda spark, what: paths.append(tmp_path / f"{what}-{len(paths)}") or f"file://{paths[-1]}")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        links = spark.createDataFrame([(100 * k + i, 100 * k + i + 1) for k in range(9) for i in range(30)], "a long, b long").repartition(40)
        got = {r["node"]: r["comp"] for r in graph.components(links).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == 9 * 31 and all(len({got[100 * k + i] for i in range(31)}) == 1 for k in range(9)) and len(set(got.values())) == 9
    assert len(paths) > 4 and all(len(list(p.glob("*.parquet"))) == 1 for p in paths[1:])  # how many links there are is not known before the first


def test_passages_of_two_texts_do_not_join_all(spark):
    passages = [[f"p{k}_{i}" for i in range(70)] for k in range(300)]
    texts = [" ".join([f"t{d}_{i}" for i in range(180)] + passages[d] + [f"u{d}_{i}" for i in range(180)] + passages[(d + 1) % 300]) for d in range(300)]
    join = jaccard_join._Join(5, 80, 100)
    rows = spark.createDataFrame([(d, d, 0, t) for d, t in enumerate([*texts, texts[7] + " z"])], "doc_id long, th long, region long, text string")
    pivots, common = jaccard_join.choose(list(shingle_sets(["some other text of a few words"], 5)), 80, 100)[0], np.zeros(0, np.uint64)
    members = join.divide(rows, join.sets(rows, pivots, 0), pivots, common, 0, 4).collect()
    assert len(members) == 2  # a text and its near copy; each passage stands in two texts, which lie in a ring


@pytest.mark.parametrize("num", [80, 90])
def test_linked_sets_meet_in_a_rare_shingle(num):
    rng = np.random.default_rng(num)
    weak = 0
    for _ in range(600):
        n = int(rng.integers(1, 300))
        pool = np.unique(rng.integers(1, 1 << 64, 2 * n + 2, dtype=np.uint64))
        counted = jaccard_join.Counted(num, 100, np.sort(rng.choice(pool, int(len(pool) * rng.random() * 0.7), replace=False)))
        order = dict(zip(pool.tolist(), rng.permutation(len(pool)).tolist(), strict=True))
        rng.shuffle(pool)
        a = np.sort(pool[:n])
        b = np.sort(np.concatenate([pool[int(rng.integers(0, 1 + n * (100 - num) // 100)) : n], pool[n : n + int(rng.integers(0, 1 + n * (100 - num) // 200))]]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= num * (len(a) + len(b) - both):
            first = [[set(sorted(part.tolist(), key=order.get)[: counted.alone(len(s)) + 1]) for part in counted.of(s)] for s in (a, b)]
            assert any(x & y for x, y in zip(*first, strict=False))
            weak += len(first[0]) == len(first[1]) == 2
    assert weak > 20


def test_small_groups_of_pivots_share_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SIDE", 10)
    rows = [(1, k, k // 4 if k < 80 else 99 if k < 100 else None, 1) for k in range(140)]  # 20 groups of 4, one of 20, 40 of no pivot
    dealt = jaccard_join._tiles(spark.createDataFrame(rows, "region long, key long, core long, n_shingles long")).collect()
    tiles = {}
    for d in dealt:
        tiles.setdefault((d["i"], d["j"]), set()).add(d["key"])
    assert len(dealt) <= 140 * 14  # 14 parts; 26 with a part for each group
    assert all(any({a, b} <= t for t in tiles.values()) for a in range(140) for b in range(a) if not 80 <= b < a < 100)
