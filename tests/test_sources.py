import pytest

from locusweave.functions import checks, names
from locusweave.operators import query, stats
from locusweave.sources import annotations, sinks

STARTS = (41, 5556, 8487, 9361, 11127, 84598, 117287120, 118974314397, 22456307315831, 88877765432319026)


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_coordinates_stay_exact(spark):
    rows = [f"Fvb1\tmaker\tgene\t{s}\t{s}.0\t.\t+\t.\tID=g{i};Name=x" for i, s in enumerate(STARTS)]
    got = annotations.gff_genes(lines(spark, [*rows, "##gff-version 3", "Fvb1\tmaker\tmRNA\t1\t2\t.\t+\t.\tID=m;x", "Fvb1\tmaker\tgene\t1\t2\t.\t+\t.\tName=only"])).collect()
    assert sorted(r["start"] for r in got) == sorted(r["stop"] for r in got) == sorted(STARTS)


def test_comment_cuts_a_line_anywhere(spark):
    got = annotations.gff_genes(lines(spark, ["c\ts\tgene\t1\t2\t.\t+\t.\tID=g1;#note;", "c\ts\tgene\t1\t2\t.\t+\t.\tID=g#1;"])).collect()
    assert [r["gene_name"] for r in got] == ["g1"]


def test_edta_artefacts_and_names(spark):
    line = "c\tEDTA\tr\t5\t9\t.\t+\t.\tID=1;Classification={};x"
    kinds = ["LTR/RLC", "DNA/DTH", "MITE/DTM", "DNA/Helitron", "Helitron/unknown", "LINE/unknown", "Unknown", "pararetrovirus/a"]
    rows = lines(spark, [*map(line.format, kinds), "c\tEDTA\tr\t5\t9\t.\t+\t.\tID=1"])
    raw = {(r["te_order"], r["superfamily"]) for r in annotations.gff_tes(rows).collect()}
    assert ("Unknown", "None") in raw and ("nan", "nan") in raw
    named = {(r["te_order"], r["superfamily"]) for r in annotations.gff_tes(rows, names.rename_edta).collect()}
    assert named == {("LTR", "Copia"), ("TIR", "PIF-Harbinger"), ("TIR", "Mutator"), ("Helitron", "Helitron"), ("LINE", "Unknown_LINE_Superfam"), ("Completely_Unknown", "Completely_Unknown"), ("pararetrovirus", "pararetrovirus"), ("nan", "nan")}


def test_mapping_is_one_pass(spark):
    rows = spark.createDataFrame([("c", "MITE", "x"), ("c", "DNA", "x")], "chrom string, te_order string, superfamily string")
    assert sorted(r["te_order"] for r in names.rename_legacy(rows).collect()) == ["DNA", "TIR"]


def test_tables_round_trip(spark, tmp_path):
    head = "Gene_Name\tChromosome\tFeature\tStart\tStop\tStrand\tLength\n"
    path = tmp_path / "genes.tsv"
    path.write_text(head + "a\tc1\tgene\t5.0\t9.0\t.\t5.0\nb\tc1\tgene\t15\t19\t-\t5\nc\tNA\tgene\t1\t2\t+\t2\n")
    genes = annotations.read_genes(spark, str(path))
    assert {(r["gene_name"], r["chrom"], r["start"], r["strand"]) for r in genes.collect()} == {("a", "c1", 5, "+"), ("b", "c1", 15, "-"), ("c", None, 1, "+")}
    path.write_text(head + "a\tc1\tgene\t5\t9\tx\t5\n")
    with pytest.raises(ValueError):
        annotations.read_genes(spark, str(path))
    path.write_text(head + "a\tc1\tgene\t5\t9\t+\t5\na\tc2\tgene\t5\t9\t+\t5\n")
    with pytest.raises(ValueError):
        annotations.read_genes(spark, str(path))
    ini = tmp_path / "run.ini"
    ini.write_text("[density_parameters]\nfirst_window_size = 500\nwindow_delta = 500\nlast_window_size = 10000\n")
    assert list(annotations.windows_from_ini(str(ini))) == list(range(500, 10001, 500))


def test_sinks(spark, tmp_path):
    tes = spark.createDataFrame([("g", "c1", 5, 9, "+", "LTR", "Copia", 5), ("g", "c2", 1, 9, "-", "TIR", "hAT", 9)], "genome_id string, chrom string, start long, stop long, strand string, te_order string, superfamily string, length long")
    sinks.write_cache(tes, str(tmp_path / "cache"))
    sinks.write_cache(tes.where("chrom = 'c1'"), str(tmp_path / "cache"))
    assert checks.same_content(spark.read.parquet(str(tmp_path / "cache")).select(tes.columns), tes)
    sinks.write_gff(tes, str(tmp_path / "gff"))
    got = sorted(r["value"] for r in spark.read.text(str(tmp_path / "gff")).collect())
    assert got == ["c1\tTest\tLTR/Copia\t5\t9\t.\t+\t1\tTest", "c2\tTest\tTIR/hAT\t1\t9\t.\t-\t1\tTest"]
    with pytest.raises(ValueError):
        sinks.write_cache(tes, str(tmp_path / "x"), "rar")


def test_checks(spark):
    genes = spark.createDataFrame([("c1", "a", "+"), ("c2", "b", None), ("c2", "b", "?")], "chrom string, gene_name string, strand string")
    assert checks.bad_strands(genes).count() == 2
    assert [r["gene_name"] for r in checks.drop_all_duplicates(genes).collect()] == ["a"]
    tes = spark.createDataFrame([("c1",), ("c3",)], "chrom string")
    assert {tuple(r) for r in checks.chromosome_difference(genes, tes).collect()} == {("c2", "genes"), ("c3", "tes")}
    with pytest.raises(ValueError):
        checks.validate(genes, tes)
    one = spark.createDataFrame([("g",), ("g",)], "genome_id string")
    assert checks.single_genome(one) == "g"
    for rows in ([], [("g",), ("h",)]):
        with pytest.raises(RuntimeError):
            checks.single_genome(spark.createDataFrame(rows, "genome_id string"))
    with pytest.raises(TypeError):
        checks.same_content(one, tes)


def test_slice_arguments():
    windows = (500, 1000)
    query.check_slice("Upstream", "Order", 500, windows)
    query.check_slice("Intra", "Superfamily", None, windows)
    for bad in (("Left", "Order", 500), ("Upstream", "Family", 500), ("Upstream", "Order", None), ("Intra", "Order", 500), ("Upstream", "Order", 700)):
        with pytest.raises(ValueError):
            query.check_slice(*bad, windows)


def test_bins_and_tests(spark):
    values = [0.0, 0.1, 0.10000001, 0.3, 0.30000000000000004, 0.6, 1.0, 1.1, -0.1, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in rows.select(stats.density_bin(rows["v"])).collect()]
    assert got == ["[0.0 0.1]", "[0.0 0.1]", "(0.1 0.2]", "(0.2 0.3]", "(0.2 0.3]", "(0.5 0.6]", "(0.9 1.0]", None, None, None]
    assert stats.count_bins(rows, rows["v"]).count() == 10
