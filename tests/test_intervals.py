"""Hand-computed cases of windows, overlaps, unions and densities, and random genomes against a count of single bases."""

import random

import pytest
from pyspark.sql import functions as F

from locusweave.operators.density import dense_density, sparse_density, stranded
from locusweave.operators.rangejoin import overlap_join
from locusweave.operators.regions import regions
from locusweave.operators.union import interval_union, revise
from locusweave.schema import INTRA, LEFT, RIGHT

GENE = "chrom string, gene_name string, feature string, start long, stop long, strand string, length long"
TE = "chrom string, start long, stop long, strand string, te_order string, superfamily string"

#: start, stop, window, expected bases left, inside, right of the gene 1000-2000
SCENARIOS = [
    (700, 800, 500, 101, 0, 0), (2700, 2800, 1000, 0, 0, 101), (400, 800, 500, 302, 0, 0), (2400, 2700, 500, 0, 0, 102),
    (800, 1500, 500, 200, 501, 0), (1500, 2200, 500, 0, 501, 200), (1500, 1700, 500, 0, 201, 0), (1000, 2000, 500, 0, 1001, 0),
    (300, 1200, 500, 501, 201, 0), (1250, 2600, 500, 0, 751, 501), (800, 2200, 500, 200, 1001, 200), (300, 2800, 500, 501, 1001, 501),
    (700, 2372, 500, 300, 1001, 372), (701, 2372, 500, 299, 1001, 372), (300, 2248, 500, 501, 1001, 248), (879, 2800, 500, 121, 1001, 501),
    (500, 1000, 500, 500, 1, 0), (600, 1000, 500, 400, 1, 0), (2000, 2200, 500, 0, 1, 200), (1001, 1999, 500, 0, 999, 0),
]


def gene(name, start, stop, strand="+", chrom="c"):
    return (chrom, name, "gene", start, stop, strand, stop - start + 1)


def test_overlap_scenarios(spark):
    genes = spark.createDataFrame([gene(f"g{i}", 1000, 2000, chrom=f"c{i}") for i in range(len(SCENARIOS))], GENE)
    tes = spark.createDataFrame([(f"c{i}", s[0], s[1], "+", "X", "x") for i, s in enumerate(SCENARIOS)], TE)
    got = {(r["chrom"], r["direction"], r["window"]): (r["overlap_bp"], r["density"]) for r in sparse_density(genes, tes, (500, 1000)).where("te_category = 'Order'").collect()}
    for i, (_, _, w, left, intra, right) in enumerate(SCENARIOS):
        for direction, window, bp in ((LEFT, w, left), (INTRA, None, intra), (RIGHT, w, right)):
            n, share = got.get((f"c{i}", direction, window), (0, 0.0))
            assert n == bp, (i, direction)
            assert share == bp / (1001 if window is None else window + 1)


def test_divisors_and_clipped_windows(spark):
    genes = spark.createDataFrame([gene("a", 41, 2396), gene("b", 501, 900), gene("c", 502, 900), gene("d", 0, 10)], GENE)
    got = {(r["gene_name"], r["direction"], r["window"]): (r["r_start"], r["r_stop"], r["divisor"]) for r in regions(genes, (500, -3)).collect()}
    assert got["a", LEFT, 500] == (0, 40, 41)
    assert got["b", LEFT, 500] == (0, 500, 501)
    assert got["c", LEFT, 500] == (1, 501, 501)
    assert got["d", LEFT, 500][2] is None
    assert got["a", RIGHT, 500] == (2397, 2897, 501)
    assert got["a", INTRA, None] == (41, 2396, 2356)
    assert len(got) == 12


def test_end_to_end_densities(spark):
    genes = spark.createDataFrame([gene("g1", 100, 2300), gene("g2", 6000, 7900, "-"), gene("g3", 8000, 8500, "-")], GENE)
    spans = [(3350, 4100), (4870, 5229), (8459, 9370), (9556, 9677), (9678, 11249), (11250, 11469)]
    tes = spark.createDataFrame([("c", a, b, "-", "T", "t") for a, b in spans], TE)
    cube = dense_density(genes, tes, (500, 1000, 1500, 2000)).where("te_category = 'Order'")
    d = {(r["gene_name"], r["direction"], r["window"]): r["density"] for r in cube.collect()}
    assert len(d) == 27
    assert d["g1", RIGHT, 2000] == pytest.approx(751 / 2001, rel=1e-12)
    assert d["g3", RIGHT, 2000] == pytest.approx((871 + 122 + 823) / 2001, rel=1e-12)
    assert d["g2", LEFT, 1000] == pytest.approx(231 / 1001, rel=1e-12)
    assert d["g3", INTRA, None] == pytest.approx(42 / 501, rel=1e-12)
    assert d["g1", LEFT, 500] == 0
    s = {(r["gene_name"], r["direction"], r["window"]): r["density"] for r in stranded(cube).collect()}
    assert s["g1", "Downstream", 2000] == d["g1", RIGHT, 2000]
    assert s["g2", "Downstream", 1000] == d["g2", LEFT, 1000]
    assert s["g3", "Intra", None] == d["g3", INTRA, None]


def test_union_touching_nested_and_adjacent(spark):
    rows = [("c", 3350, 3957, "+", "LTR", "Copia"), ("c", 3350, 3957, "-", "LTR", "Gypsy"), ("c", 4209, 4761, "+", "LTR", "Gypsy"), ("c", 4761, 5000, "+", "LTR", "Copia"),
            ("c", 12100, 12300, "+", "TIR", "hAT"), ("c", 12150, 12200, "+", "TIR", "hAT"), ("c", 12301, 12310, "+", "TIR", "hAT"), (None, 1, 5, "+", "TIR", "hAT"), ("c", 1, 5, "+", None, None)]
    revised = revise(spark.createDataFrame(rows, TE)).collect()
    pick = lambda o: [r["length"] for r in sorted((r for r in revised if r["te_order"] == o), key=lambda r: r["start"])]
    assert pick("LTR") == [608, 792]
    assert pick("TIR") == [201, 10]
    assert pick("All_Elements") == [5, 608, 792, 201, 10]


@pytest.mark.parametrize("stretch", [7, 50, 1 << 20])
def test_union_against_bases(spark, stretch):
    rng = random.Random(stretch)
    rows = [(rng.choice("ab"), s := rng.randrange(400), s + rng.choice([0, 1, 5, 60]), "+", "o", "f") for _ in range(150)]
    rows += rows[:20]
    got = interval_union(spark.createDataFrame(rows, TE), ["chrom"], stretch).collect()
    want = []
    for c in "ab":
        end = None
        for _, s, e, *_ in sorted(r for r in rows if r[0] == c):
            if end is None or s > end:
                want.append([c, s, e])
            end = want[-1][2] = max(want[-1][2], e)
    assert sorted((r["chrom"], r["start"], r["stop"], r["length"]) for r in got) == sorted((c, s, e, e - s + 1) for c, s, e in want)


@pytest.mark.parametrize("size", [1, 5, 13])
def test_overlap_join_meets_each_pair_once(spark, size):
    rng = random.Random(size)
    spans = lambda n: [(i, rng.choice("ab"), s := rng.randrange(300), s + rng.randrange(80)) for i in range(n)]
    left, right = spans(60), spans(70)
    a = spark.createDataFrame(left, "i int, chrom string, a long, b long")
    b = spark.createDataFrame(right, "j int, chrom string, c long, d long")
    got = sorted((r["i"], r["j"], r["overlap_bp"]) for r in overlap_join(a, b, ["chrom"], ("a", "b"), ("c", "d"), size).collect())
    want = sorted((i, j, min(y, w) - max(x, v) + 1) for i, c, x, y in left for j, k, v, w in right if c == k and x <= w and v <= y)
    assert got == want


def test_densities_lie_between_0_and_1(spark):
    rng = random.Random(5)
    genes = spark.createDataFrame([gene(f"g{i}", s := rng.randrange(1, 5000), s + 200, rng.choice("+-")) for i in range(20)], GENE)
    tes = spark.createDataFrame([("c", s := rng.randrange(1, 6000), s + rng.randrange(300), "+", rng.choice("XY"), rng.choice("xyz")) for _ in range(80)], TE)
    cube = dense_density(genes, revise(tes), (100, 1000))
    real = cube.where(~F.col("te_name").contains("Revision"))
    assert real.where("density < 0 OR density > 1").isEmpty()
    sums = real.where("te_category = 'Order'").groupBy("gene_name", "direction", "window").agg(
        F.sum(F.when(F.col("te_name") != "All_Elements", F.col("overlap_bp"))).alias("parts"), F.max(F.when(F.col("te_name") == "All_Elements", F.col("overlap_bp"))).alias("all")
    )
    assert sums.where("parts < `all`").isEmpty()


def test_joins_are_not_cartesian(spark):
    genes = spark.createDataFrame([gene("a", 1000, 2000)], GENE)
    tes = spark.createDataFrame([("c", 1, 5, "+", "X", "x")], TE)
    plan = sparse_density(genes, tes, (500,))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
