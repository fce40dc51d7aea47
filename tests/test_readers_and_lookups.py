"""Readers without a query of their own, point lookups, and the checks before tables are compared."""

import math

import pytest
from pyspark.sql import functions as F

from locusweave.functions import checks
from locusweave.operators import query, stats
from locusweave.operators.density import dense_density
from locusweave.operators.regions import regions
from locusweave.operators.union import revise
from locusweave.sources import annotations, sinks

GENE = "genome_id string, chrom string, gene_name string, feature string, start long, stop long, strand string, length long"
TE = "genome_id string, chrom string, start long, stop long, strand string, te_order string, superfamily string, length long"


@pytest.fixture
def genes(spark):
    return spark.createDataFrame([("x", "01", "a", "gene", 1000, 2000, "+", 1001), ("x", "2", "b", "gene", 5000, 5500, "-", 501)], GENE)


@pytest.fixture
def tes(spark):
    return spark.createDataFrame([("x", "01", 700, 800, "+", "LTR", "Copia", 101), ("x", "2", 5600, 5700, "+", "LTR", "Gypsy", 101)], TE)


@pytest.fixture
def cube(genes, tes):
    return dense_density(genes, revise(tes), (500,))


def test_cached_chromosomes(spark, genes, tes, tmp_path):
    sinks.write_cache(genes, str(tmp_path / "genes"))
    sinks.write_cache(tes, str(tmp_path / "tes"))
    assert [r["gene_name"] for r in annotations.read_cached_genes(spark, str(tmp_path / "genes"), "01").collect()] == ["a"]
    assert [r["superfamily"] for r in annotations.read_cached_tes(spark, str(tmp_path / "tes"), "2").collect()] == ["Gypsy"]
    with pytest.raises(RuntimeError):
        annotations.read_cached_genes(spark, str(tmp_path / "genes"), "1")


def test_density_with_genes(spark, genes, cube, tmp_path):
    from pyspark.sql import functions as F

    sinks.write_density(cube.withColumn("genome_id", F.lit("x")), str(tmp_path / "d"))
    assert annotations.read_density_with_genes(spark, str(tmp_path / "d"), genes).count() == cube.count()
    with pytest.raises(ValueError):
        annotations.read_density_with_genes(spark, str(tmp_path / "d"), genes.where("chrom = '2'"))


def test_density_files_by_name(spark, cube, tmp_path):
    cube.where("chrom = '2'").coalesce(1).write.parquet(str(tmp_path / "x_2"))
    assert annotations.read_density_files(spark, str(tmp_path / "x_2"), r"x_([^/]+)/").count() == cube.where("chrom = '2'").count()
    with pytest.raises(ValueError):
        annotations.read_density_files(spark, str(tmp_path / "x_2"), r"(x)_[^/]+/").count()


def test_files_by_suffix(spark, tmp_path):
    (tmp_path / "deep/er").mkdir(parents=True)
    for name in ("b.h5", "a.txt", "deep/er/a.h5"):
        (tmp_path / name).write_text("1")
    assert [r["path"].rpartition(tmp_path.name)[2] for r in annotations.list_files(spark, str(tmp_path), ".h5").collect()] == ["/b.h5", "/deep/er/a.h5"]


def test_expression_and_orthologs(spark, tmp_path):
    (tmp_path / "tpm.tsv").write_text("Gene\tleaf 1\troot.2\na\t9\t99\nb\tNA\t1\n")
    matrix = annotations.read_expression(spark, str(tmp_path / "tpm.tsv"))
    assert matrix.columns == ["gene_name", "leaf 1", "root.2"]
    assert {tuple(r) for r in annotations.one_library(matrix, "leaf 1").collect()} == {("a", 1.0), ("b", None)}
    assert {r[0] for r in matrix.select(stats.row_mean(["`leaf 1`", "`root.2`"])).collect()} == {54.0, 1.0}
    (tmp_path / "fpkm.csv").write_text("Gene,Other,Control 1 - 43A FPKM\na,x,9\nb,y,99\n")
    assert {tuple(r) for r in annotations.read_fpkm(spark, str(tmp_path / "fpkm.csv"), "Control 1 - 43A FPKM").collect()} == {("a", 1.0), ("b", 2.0)}
    (tmp_path / "o.tsv").write_text("gene_a\tgene_b\ng\tNA\n")
    assert [tuple(r) for r in annotations.read_orthologs(spark, str(tmp_path / "o.tsv")).collect()] == [("g", None)]
    (tmp_path / "names").write_text(" a \n\nb\n")
    assert [r[0] for r in annotations.read_names(spark, str(tmp_path / "names")).collect()] == ["a", "b"]


def test_name_lists_and_tables_round_trip(spark, genes, tes, tmp_path):
    sinks.write_names(genes, str(tmp_path / "n"))
    assert sorted(r[0] for r in annotations.read_names(spark, str(tmp_path / "n")).collect()) == ["a", "b"]
    sinks.write_cleaned_genes(genes, str(tmp_path / "g"))
    assert checks.same_content(annotations.read_genes(spark, str(tmp_path / "g")).select("gene_name", "start", "length"), genes.select("gene_name", "start", "length"))
    sinks.write_cleaned_tes(tes, str(tmp_path / "t"))
    assert checks.same_content(annotations.read_tes(spark, str(tmp_path / "t")), tes.drop("genome_id"))
    (tmp_path / "pairs").write_text("a1_3\tx||1||2||CDS:g1.1||z\t1\t2\tb2_3\ty||1||2||CDS:Os1t5-01||z\t3\t4\t0.01\t50\n")
    assert [tuple(r) for r in annotations.read_gene_pairs(spark, str(tmp_path / "pairs")).collect()] == [("3", "g1", "Os1g5", 0.01)]


def test_scaffold_prefix(genes):
    assert {r["chrom"] for r in annotations.prefix_chromosomes(genes, "Scaff").collect()} == {"Scaff01", "Scaff2"}


def test_lookups(spark, genes, cube):
    assert query.gene(genes, "a").count() == 1
    with pytest.raises(KeyError):
        query.gene(cube, "z")
    query.require_name(cube, "Order", "LTR")
    with pytest.raises(ValueError):
        query.require_name(cube, "Order", "TIR")
    wanted = spark.createDataFrame([("b", 0), ("z", 1), ("a", 2)], "gene_name string, place int")
    assert [(r["gene_name"], r["start"]) for r in query.reindex(genes, wanted).orderBy("place").collect()] == [("b", 5000), ("z", None), ("a", 1000)]
    assert sorted(r["gene_name"] for r in checks.known_only(wanted, genes).collect()) == ["a", "b"]
    with pytest.raises(KeyError):
        query.require_genes(cube, wanted)
    assert [tuple(r) for r in query.dimension(cube, "direction").orderBy("place").collect()] == [("Intra", 0), ("Left", 1), ("Right", 2)]
    query.register_views(genes, genes, cube)
    assert spark.sql("SELECT count(*) FROM density d JOIN genes g USING (gene_name) WHERE d.window = 500").first()[0] > 0


def test_unequal_cubes_are_not_compared(spark, genes, tes, cube):
    pairs = spark.createDataFrame([("a", "b")], "gene_a string, gene_b string")
    assert query.paired_differences(pairs, cube, cube, check=True).count() > 0
    with pytest.raises(ValueError):
        query.paired_differences(pairs, cube, dense_density(genes, revise(tes), (800,)), check=True)
    with pytest.raises(ValueError):
        query.paired_differences(pairs, cube, cube.where("te_name <> 'LTR'"), check=True)
    with pytest.raises(TypeError):
        query.paired_differences(pairs, cube, cube.drop("strand"), check=True)
    with pytest.raises(KeyError):
        query.paired_differences(pairs.selectExpr("gene_a", "'q' AS gene_b"), cube, cube, check=True)


def test_only_fitting_rows_are_added(spark, genes, tes, cube, tmp_path):
    cube.write.parquet(str(tmp_path / "c"))
    sinks.append_checked(cube, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2 * cube.count()
    with pytest.raises(ValueError):
        sinks.append_checked(dense_density(genes, revise(tes), (700,)), str(tmp_path / "c"))
    with pytest.raises(TypeError):
        sinks.append_checked(cube.drop("divisor"), str(tmp_path / "c"))


def test_p_values_as_a_column(spark):
    values = [3.841458820694124, None, 0.0, 1e-9, 0.3, 1.999, 2.0, 2.001, 7.5, 40.0, 300.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(stats.chi_square_p(F.col("x"))).collect()]
    for v, p in zip(values, got, strict=True):
        assert p is None if v is None else p == pytest.approx(math.erfc(math.sqrt(v / 2)), rel=1e-9)


#: Start, stop, and the divisors of left windows 500, 3500 and 7000 (intra is the length, right is the window and one).
DIVISORS = [(41, 2396, 41, 41, 41), (5556, 6728, 501, 3501, 5556), (8487, 8797, 501, 3501, 7001), (501, 900, 501, 501, 501), (3502, 3600, 501, 3501, 3502), (7002, 7100, 501, 3501, 7001)]


def test_divisors(spark):
    genes = spark.createDataFrame([("x", "c", f"g{a}", "gene", a, b, "+", b - a + 1) for a, b, *_ in DIVISORS], GENE)
    got = {(r["gene_name"], r["direction"], r["window"]): r["divisor"] for r in regions(genes, (500, 3500, 7000)).collect()}
    for a, b, *left in DIVISORS:
        for w, n in zip((500, 3500, 7000), left, strict=True):
            assert got[f"g{a}", "Left", w] == n and got[f"g{a}", "Right", w] == w + 1
        assert got[f"g{a}", "Intra", None] == b - a + 1
