import logging

import pytest

from locusweave import cli
from locusweave.operators.density import dense_density
from locusweave.operators.union import revise
from locusweave.sources import annotations, sinks
from locusweave.streaming.densities import stream_density

GENES = "Gene_Name\tChromosome\tFeature\tStart\tStop\tStrand\tLength\ng1\tc\tgene\t100\t2300\t+\t2201\ng2\tc\tgene\t6000\t7900\t-\t1901\n"
TES = "Chromosome\tStart\tStop\tStrand\tOrder\tSuperFamily\tLength\nc\t3350\t4100\t-\tLTR\tCopia\t751\nc\t3400\t5229\t-\tLTR\tGypsy\t1830\n"


def test_run_from_the_command_line(spark, tmp_path):
    (tmp_path / "g.tsv").write_text(GENES)
    (tmp_path / "t.tsv").write_text(TES)
    (tmp_path / "w.ini").write_text("[density_parameters]\nfirst_window_size = 400\nwindow_delta = 200\nlast_window_size = 2000\n")
    argv = [str(tmp_path / "g.tsv"), str(tmp_path / "t.tsv"), "x", "-c", str(tmp_path / "w.ini"), "-o", str(tmp_path / "out")]
    path = cli.main(argv)
    got = annotations.read_density(spark, path, "x")
    row = got.where("gene_name = 'g1' AND direction = 'Right' AND window = 2000 AND te_name = 'LTR'").collect()
    assert len(row) == 1 and row[0]["overlap_bp"] == 4301 - 3350 + 1
    assert got.count() == 2 * (9 * 2 + 1) * (3 + 4)
    assert cli.main(argv) == path
    assert got.count() == 2 * (9 * 2 + 1) * (3 + 4)


def test_other_windows_inputs_and_modes_have_tables_of_their_own(spark, tmp_path):
    (tmp_path / "g.tsv").write_text(GENES)
    (tmp_path / "t.tsv").write_text(TES)
    ini = "[density_parameters]\nfirst_window_size = {0}\nwindow_delta = 1\nlast_window_size = {0}\n"
    argv = [str(tmp_path / "g.tsv"), str(tmp_path / "t.tsv"), "x", "-c", str(tmp_path / "w.ini"), "-o", str(tmp_path / "out")]
    found = []
    for window in (400, 800):
        (tmp_path / "w.ini").write_text(ini.format(window))
        found.append(cli.main(argv))
        got = annotations.read_density(spark, found[-1])
        assert [r[0] for r in got.where("window IS NOT NULL").select("window").distinct().collect()] == [window]
    found.append(cli.main([*argv, "--sparse"]))
    assert annotations.read_density(spark, found[-1]).where("overlap_bp = 0").isEmpty()
    (tmp_path / "t.tsv").write_text(TES + "c\t1\t50\t-\tTIR\thAT\t50\n")
    found.append(cli.main(argv))
    assert not annotations.read_density(spark, found[-1]).where("te_name = 'TIR'").isEmpty()
    assert len(set(found)) == 4


def test_raw_annotations_to_densities(spark, tmp_path):
    """GFF to cleaned tables to the command line; chromosomes 01 and 1 stay apart."""
    (tmp_path / "g.gff").write_text("".join(f"{c}\ts\tgene\t1000\t2000\t.\t+\t.\tID=g{i};x\n" for i, c in enumerate(("01", "1"))))
    (tmp_path / "t.gff").write_text("".join(f"{c}\ts\tr\t{a}\t{b}\t.\t+\t.\tID=1;Classification=LTR/Copia;x\n" for c, a, b in (("01", 700, 800), ("1", 100, 200))))
    sinks.write_cleaned_genes(annotations.read_gff_genes(spark, str(tmp_path / "g.gff")), str(tmp_path / "genes"))
    sinks.write_cleaned_tes(annotations.read_gff_tes(spark, str(tmp_path / "t.gff")), str(tmp_path / "tes"))
    (tmp_path / "w.ini").write_text("[density_parameters]\nfirst_window_size = 500\nwindow_delta = 1\nlast_window_size = 500\n")
    got = annotations.read_density(spark, cli.main([str(tmp_path / "genes"), str(tmp_path / "tes"), "x", "-c", str(tmp_path / "w.ini"), "-o", str(tmp_path / "out")]))
    rows = got.where("te_name = 'LTR' AND direction = 'Left'").select("chrom", "gene_name", "overlap_bp").collect()
    assert {tuple(r) for r in rows} == {("01", "g0", 101), ("1", "g1", 0)}


def test_stream_of_genes(spark, tmp_path):
    (tmp_path / "g.tsv").write_text(GENES)
    (tmp_path / "t.tsv").write_text(TES)
    genes, revised = annotations.read_genes(spark, str(tmp_path / "g.tsv")), revise(annotations.read_tes(spark, str(tmp_path / "t.tsv"))).cache()
    genes.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(genes.schema).parquet(str(tmp_path / "in"))
    stream_density(stream, revised, (500, 1000), str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = dense_density(genes, revised, (500, 1000))
    assert got.count() == want.count()
    columns = ["gene_name", "direction", "window", "te_name", "te_category", "overlap_bp"]
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty()


def test_gene_list_and_absent_files(spark, tmp_path, caplog):
    (tmp_path / "g.tsv").write_text(GENES)
    (tmp_path / "t.tsv").write_text(TES)
    (tmp_path / "names.txt").write_text("g2\nunknown\n")
    argv = [str(tmp_path / "g.tsv"), str(tmp_path / "t.tsv"), "x", "-o", str(tmp_path / "out"), "--genes_list", str(tmp_path / "names.txt")]
    with caplog.at_level(logging.ERROR):
        got = annotations.read_density(spark, cli.main(argv))
    assert [r[0] for r in got.select("gene_name").distinct().collect()] == ["g2"] and "unknown" in caplog.text
    with pytest.raises(FileNotFoundError):
        cli.main([str(tmp_path / "no.tsv"), *argv[1:]])
    assert not cli.exists(spark, str(tmp_path)) and not cli.exists(spark, str(tmp_path / "nowhere"))
