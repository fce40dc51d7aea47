"""What large tables need: unions by stretch, running sums, bins of many sizes, exact selection, stored parts."""

import glob
import hashlib
import logging
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusweave.functions import checks
from locusweave.operators import coverage, density, increments, quantiles, query
from locusweave.operators.coverage import region_bases
from locusweave.operators.rangejoin import overlap_join
from locusweave.operators.union import interval_union, revise
from locusweave.sources import cubes, sinks

TE = "chrom string, start long, stop long, strand string, te_order string, superfamily string"
GENE = "chrom string, gene_name string, start long, stop long, strand string, length long"


def islands(rows):
    out = []
    for c in sorted({r[0] for r in rows}):
        end = None
        for _, s, e, *_ in sorted(r for r in rows if r[0] == c):
            if end is None or s > end:
                out.append([c, s, e])
            end = out[-1][2] = max(out[-1][2], e)
    return sorted((c, s, e, e - s + 1) for c, s, e in out)


def elements(rng, n, far=400):
    return [(rng.choice("ab"), s := rng.randrange(-20, far), s + rng.choice([0, 1, 5, 60]), rng.choice("+-"), rng.choice("xy"), rng.choice("fgh")) for _ in range(n)]


@pytest.mark.parametrize("joins", ["-1", "10485760"])
@pytest.mark.parametrize("seed", range(4))
def test_union_of_repeated_rows(spark, seed, joins):
    rng = random.Random(seed)
    rows = elements(rng, 120) * 3
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)
    try:
        for stretch in (7, 50, 1 << 20):
            got = interval_union(spark.createDataFrame(rows, TE), ["chrom"], stretch).collect()
            assert sorted((r["chrom"], r["start"], r["stop"], r["length"]) for r in got) == islands(rows)
            first = {(r["chrom"], r["start"]): r["strand"] for r in got}
            for c, s, *_ in islands(rows):
                assert first[c, s] == min((r[2], r[3]) for r in rows if r[0] == c and r[1] == s)[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("stretch", [16, 100, 1 << 20])
def test_running_sums_against_bases(spark, stretch):
    rng = random.Random(stretch)
    tes = [(c, s, e, [o, f]) for c, s, e, _, o, f in elements(rng, 150)] + [("a", -5, 10**12, ["x"]), ("a", 3 * 10**16, 3 * 10**16 + 9, ["f"]), ("b", 9, 3, ["x"]), (None, 1, 2, ["x"]), ("a", None, 4, ["x"])]
    spans = [(rng.choice("abc"), f"g{i}", s := rng.randrange(-30, 450), s + rng.choice([0, 3, 90])) for i in range(60)]
    spans += [("a", "far", 3 * 10**16 - 4, 3 * 10**16 + 2), ("a", "long", 5, 4 * 10**16), ("b", "none", None, 7), ("b", "back", 40, 30)]
    regions = [("a", "b"), ("a - 10", "a - 1"), ("b + 1", "b + 25")]
    got = region_bases(
        spark.createDataFrame(spans, "chrom string, gene string, a long, b long").where("a IS NOT NULL"), ["chrom", "gene", "a", "b"], regions,
        spark.createDataFrame(tes, "chrom string, start long, stop long, names array<string>"), F.col("names"), stretch, part=5,
    ).collect()
    found = {(r["gene"], r["name"]): (r["bases_0"], r["bases_1"], r["bases_2"]) for r in got}
    kept = [t for t in tes if t[0] and t[1] is not None and t[2] >= t[1]]
    want = {}
    for c, g, a, b in spans:
        if a is not None:
            for n in {n for t in kept if t[0] == c for n in t[3]}:
                want[g, n] = tuple(sum(t[3].count(n) * max(0, min(t[2], y) - max(t[1], x) + 1) for t in kept if t[0] == c) if y >= x else 0 for x, y in ((a, b), (a - 10, a - 1), (b + 1, b + 25)))
    assert found == want


def test_cube_has_no_pairs_in_its_plan(spark):
    genes = spark.createDataFrame([("c", "g", 1000, 2000, "+", 1001)], GENE)
    tes = spark.createDataFrame([("c", 1, 5, "+", "X", "x")], TE)
    plan = density.dense_density(genes, tes, range(500, 10_001, 500))._jdf.queryExecution().executedPlan().toString()
    assert "te_start" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_bins_of_many_sizes(spark):
    rng = random.Random(2)
    spans = lambda n: [(i, rng.choice("ab"), s := rng.choice([rng.randrange(300), rng.randrange(10**6), 10**15]), s + rng.choice([0, 7, 80, 5000, 10**6, 10**12])) for i in range(n)]
    left, right = spans(70), [*spans(80), (80, "a", 0, 2**62)]
    a, b = spark.createDataFrame(left, "i int, chrom string, a long, b long"), spark.createDataFrame(right, "j int, chrom string, c long, d long")
    want = sorted((i, j, min(y, w) - max(x, v) + 1) for i, c, x, y in left for j, k, v, w in right if c == k and x <= w and v <= y)
    for smallest, most in ((1, 3), (13, 100_000)):
        got = overlap_join(a, b, ["chrom"], ("a", "b"), ("c", "d"), smallest, most).collect()
        assert sorted((r["i"], r["j"], r["overlap_bp"]) for r in got) == want


def test_bin_with_a_million_intervals(spark):
    many = spark.range(1_000_000).selectExpr("'a' AS chrom", "id AS j", "5000 + id % 100 AS c", "5000 + id % 100 AS d")
    left = spark.createDataFrame([(1, "a", 0, 10**12), (2, "a", 5010, 5019), (3, "b", 0, 10**12)], "i int, chrom string, a long, b long")
    got = overlap_join(left, many, ["chrom"], ("a", "b"), ("c", "d")).groupBy("i").agg(F.count("*").alias("n"), F.count_distinct("j").alias("k")).collect()
    assert sorted((r["i"], r["n"], r["k"]) for r in got) == [(1, 1_000_000, 1_000_000), (2, 100_000, 100_000)]


def test_exact_selection(spark, monkeypatch):
    rng = random.Random(4)
    tables = [[1.5], [2.0] * 50, [rng.random() for _ in range(501)], [rng.choice([0.0, 0.25, 1e-300, -7.5, 1e300]) for _ in range(300)], [0.0] * 400 + [rng.gauss(0, 1) for _ in range(101)]]
    for few in (1 << 14, 3):
        monkeypatch.setattr(quantiles, "FEW", few)
        monkeypatch.setattr(quantiles, "PARTS", 8)
        for values in tables:
            rows = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
            got = quantiles.exact_quantiles(rows, "v", [0, 0.01, 0.37, 0.5, 0.99, 1])
            assert got == pytest.approx(np.quantile(values, [0, 0.01, 0.37, 0.5, 0.99, 1]).tolist(), rel=1e-12)
    assert quantiles.exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


def test_grouped_medians(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, rng.randrange(-9, 9), rng.randrange(10**12), -rng.randrange(10**6)])) for _ in range(900)] + [("one", 7)]
    got = {r[0]: r[1] for r in quantiles.grouped_medians(spark.createDataFrame(rows, "g string, v long"), "g", "v").collect()}
    assert got == {g: statistics.median(v for k, v in rows if k == g and v is not None) for g in ("a", "b", "c", "one")}


@pytest.mark.parametrize("few", [1 << 14, 2])
def test_sample_by_hash(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    names = [f"g{k}" for k in range(300)] + ["g7"] * 9
    rows = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    order = sorted(names, key=lambda n: (hashlib.md5(n.encode()).hexdigest(), n))
    for n in (0, 1, 40, 308, 309, 1000):
        sample = quantiles.hash_sample(rows, n, "name", bits=4)
        assert sorted(r[0] for r in sample.collect()) == sorted(order[:n])
    plan = quantiles.hash_sample(rows, 40, "name")._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "TakeOrdered" not in plan


def test_gene_index_by_stretch(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), f"g{i}", rng.choice([None, rng.randrange(-50, 900)])) for i in range(200)]
    got = {r["gene_name"]: r["gene_index"] for r in query.gene_index(spark.createDataFrame(rows, "chrom string, gene_name string, start long"), 64).collect()}
    for c in "ab":
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[2] is not None, r[2] or 0, r[1]))
        assert [got[r[1]] for r in mine] == list(range(len(mine)))


def some_genes(spark, rng, n=24, chroms="ab"):
    return spark.createDataFrame([(chroms[i % len(chroms)], f"g{i}", s := rng.randrange(1, 5000), s + 200, rng.choice("+-"), 201) for i in range(n)], GENE)


def some_tes(spark, rng, chroms="ab"):
    return spark.createDataFrame([(rng.choice(chroms), s := rng.randrange(1, 6000), s + rng.randrange(300), "+", rng.choice("XY"), rng.choice("xyz")) for _ in range(90)], TE)


def as_set(rows):
    return {tuple(r[c] for c in sorted(rows.columns)) for r in rows.collect()}


def test_merge_of_chunks(spark):
    rng = random.Random(1)
    genes, revised, windows = some_genes(spark, rng), revise(some_tes(spark, rng)).cache(), (100, 700)
    whole = as_set(density.dense_density(genes, revised, windows))
    chunks = [cubes.partial_sums(genes.where(F.pmod(F.crc32(F.col("gene_name")), F.lit(7)) == k), revised, windows) for k in range(7)]
    assert as_set(cubes.merge(chunks, windows)) == whole
    rng.shuffle(chunks)
    assert as_set(cubes.merge(chunks, windows)) == whole
    # intervals in chunks: names that a chunk lacks come from the others
    parts = [cubes.partial_sums(genes, revised.where(F.pmod("start", F.lit(2)) == k), windows) for k in range(2)]
    assert as_set(cubes.merge(parts, windows)) == whole
    cubes.same_names(chunks[:2])
    with pytest.raises(ValueError):
        cubes.merge([chunks[0], cubes.partial_sums(genes, revised, (100, 800))], windows)
    with pytest.raises(ValueError):
        cubes.merge([chunks[0], cubes.partial_sums(genes, revised, (100,))], windows)
    with pytest.raises(ValueError):
        cubes.same_names([chunks[0], cubes.partial_sums(genes, revised.where("te_order <> 'X'"), windows)])


def digests(path):
    return {f: hashlib.md5(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_stopped_run_resumes(spark, tmp_path):
    rng = random.Random(3)
    genes, revised, windows = some_genes(spark, rng), revise(some_tes(spark, rng)).cache(), (100, 700)
    store, made = cubes.CubeStore(spark, str(tmp_path)), []

    def make(chrom, fail=None):
        made.append(chrom)
        if chrom == fail:
            raise RuntimeError("stopped")
        return density.dense_density(genes.where(F.col("chrom") == chrom), revised.where(F.col("chrom") == chrom), windows)

    with pytest.raises(RuntimeError):
        store.complete("G", "ab", windows, "k", lambda c: make(c, "b"))
    with pytest.raises(ValueError):
        store.read("G", "ab", windows, "k")
    before = digests(tmp_path)
    # data without a manifest, as a run leaves that is stopped while it writes
    (tmp_path / "data" / "half").mkdir()
    assert store.complete("G", "ab", windows, "k", make) == ["b"] and made == ["a", "b", "b"]
    assert before.items() <= digests(tmp_path).items()
    cube = density.dense_density(genes, revised, windows)
    assert as_set(store.read("G", "ab", windows, "k").select(*cube.columns)) == as_set(cube)
    assert store.complete("G", "ab", windows, "k", make) == []
    assert store.complete("G", "a", windows, "other inputs", make) == ["a"] and store.complete("G", "a", (100,), "k", make) == ["a"]


def test_slice_reads_little(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cubes, "ROW_GROUP", 4096)
    rng = random.Random(5)
    genes, revised, windows = some_genes(spark, rng, 400, "a"), revise(some_tes(spark, rng, "a")).cache(), tuple(range(100, 1100, 100))
    store = cubes.CubeStore(spark, str(tmp_path))
    store.complete("G", "a", windows, "k", lambda c: density.dense_density(genes, revised, windows))
    cube = store.read("G", "a", windows, "k")
    rows = cube.where("te_category = 'Order' AND te_name = 'X' AND direction = 'Left' AND window = 300")
    plan = rows._jdf.queryExecution().executedPlan()
    assert rows._jdf.queryExecution().toRdd().count() == 400
    leaf = plan.collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() * 4 < cube.count()


@pytest.mark.parametrize("seed", range(2))
def test_union_in_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    path, rows = str(tmp_path / "u"), elements(rng, 150, 3000)
    increments.write_union(spark.createDataFrame(rows[:60], TE), ["chrom"], path, 100)
    for k in range(60, 150, 45):
        before = digests(path)
        changed = increments.add_to_union(spark.createDataFrame(rows[k : k + 45], TE), ["chrom"], path, 100)
        got = increments.read_union(spark, path).collect()
        assert sorted((r["chrom"], r["start"], r["stop"], r["length"]) for r in got) == islands(rows[: k + 45])
        assert {f: d for f, d in before.items() if not any(f"stretch={s}/" in f for s in changed)}.items() <= digests(path).items()
    before = digests(path)
    far = [("z", 10**6, 10**6 + 5, "+", "x", "f")]
    assert increments.add_to_union(spark.createDataFrame(far, TE), ["chrom"], path, 100) == [10**4]
    assert before.items() <= digests(path).items()


def test_names_that_are_not_there(spark, caplog):
    rng = random.Random(9)
    genes, revised = some_genes(spark, rng), revise(some_tes(spark, rng)).cache()
    cube = density.stranded(density.dense_density(genes, revised, (500,)))
    names = density.names_by_chromosome(revised)
    assert query.density_slice(cube, "Order", "X", "Upstream", 500, (500,), names).count() == 24
    for known in (names, None):
        with pytest.raises(ValueError):
            query.density_slice(cube, "Order", "Nowhere", "Upstream", 500, (500,), known)
    with caplog.at_level(logging.WARNING):
        query.append_columns(genes, cube, [("Order", "X", "Intra", None), ("Order", "Nowhere", "Intra", None)], names)
    assert "Nowhere" in caplog.text and "'X'" not in caplog.text


def test_checks_find_something(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "gene_name string, k int")
    assert [r["k"] for r in checks.drop_all_duplicates(rows).collect()] == [3]


def test_pairs_round_trip(spark, tmp_path):
    pairs = spark.createDataFrame([("y", "1", 0.5, "x"), (None, "2", 1e-9, "z")], "gene_b string, chrom string, e_value double, gene_a string")
    sinks.write_pairs(pairs, str(tmp_path / "p"))
    got = spark.read.csv(str(tmp_path / "p"), sep="\t", header=True)
    assert got.columns == ["chrom", "gene_a", "gene_b", "e_value"]
    assert sorted(tuple(r) for r in got.collect()) == [("1", "x", "y", "0.5"), ("2", "z", None, "1.0E-9")]
    with pytest.raises(ValueError):
        sinks.write_pairs(pairs.drop("gene_a"), str(tmp_path / "q"))


@pytest.mark.parametrize(("bits", "part"), [(4, 50_000), (6, 3), (18, 7)])
@pytest.mark.parametrize("direction", ["Left", "Intra", "Right"])
def test_overlap_counts_against_pairs(spark, monkeypatch, bits, part, direction):
    monkeypatch.setattr(coverage.region_counts, "__defaults__", (bits, part))
    monkeypatch.setattr(coverage, "PACKED", 50)
    rng = random.Random(bits)
    genes = [(rng.choice("abc"), f"g{k}", s := rng.randrange(0, 300), s + rng.choice([0, 3, 40]), "+", 1) for k in range(60)]
    genes += [genes[5], ("a", None, 30, 60, "+", 1), (None, "x", 1, 9, "+", 1), ("b", "y", None, 9, "+", 1), ("a", "far", 1 << 40, (1 << 40) + 9, "+", 1)]
    tes = [x[:3] + x[3:] for x in elements(rng, 150)] * 2 + [("b", 1, 1000, "+", "x", "f"), ("a", 50, 40, "+", "x", "f"), (None, 1, 9, "+", "x", "f"), ("a", 1 << 40, 1 << 41, "+", "x", "f"), ("d", 3, 9, "+", "x", "f")]
    want = {}
    for c, name, s, e, *_ in genes:
        if None in (c, s, e):
            continue
        for w in (None,) if direction == "Intra" else (0, 5, 20, 100):
            a, b = {"Left": lambda: (max(s - 1 - w, 0), s - 1), "Right": lambda: (e + 1, e + 1 + w), "Intra": lambda: (s, e)}[direction]()
            for tc, ts, te, *_ in tes:
                if tc == c and ts <= te and ts <= b and te >= a and a <= b:
                    n, bp = want.get((c, name, w), (0, 0))
                    want[c, name, w] = n + 1, bp + min(b, te) - max(a, ts) + 1
    got = density.overlap_counts(spark.createDataFrame(genes, GENE), spark.createDataFrame(tes, TE), (0, 5, 20, 100), direction).collect()
    assert len(got) == len(want) and {(r["chrom"], r["gene_name"], r["window"]): (r["n"], r["bp"]) for r in got} == want


def test_overlap_counts_make_no_pairs(spark):
    # 2000 genes that each meet 20 000 intervals: 40 million pairs
    genes = spark.range(2000).selectExpr("'a' AS chrom", "concat('g', id) AS gene_name", "20000 + id AS start", "20100 + id AS stop", "'+' AS strand", "101L AS length")
    tes = spark.range(20_000).selectExpr("'a' AS chrom", "id % 10 + 1 AS start", "40000 + id % 10 AS stop", "'+' AS strand", "'x' AS te_order", "'f' AS superfamily")
    counts = density.overlap_counts(genes, tes, (10, 500), "Left")
    assert not [x for x in str(counts._jdf.queryExecution().optimizedPlan()).splitlines() if "overlap_bp" in x or "te_start" in x]
    assert counts.groupBy("window").agg(F.count("*"), F.min("n"), F.max("n"), F.min("bp"), F.max("bp")).orderBy("window").collect() == [(10, 2000, 20_000, 20_000, 220_000, 220_000), (500, 2000, 20_000, 20_000, 10_020_000, 10_020_000)]
