import sys

import pytest

import __spark_entry__ as entry
from locusweave.plans.queries import ORACLES, QUERIES


def test_every_query_of_the_engine_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_llm_is_not_imported_by_the_rest():
    import subprocess

    code = "import sys; sys.modules['locusweave.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert e.queries() and not any(k.startswith('op') and k[2].isdigit() for k in e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=entry.__file__.rpartition("/")[0]).returncode == 0


@pytest.mark.parametrize("argv", [["g.tsv", "t.tsv", "x"], ["g.tsv", "t.tsv", "x", "-c", "a.ini", "-o", "out", "-n", "3", "--reset_h5", "--revise_anno"]])
def test_command_line(argv):
    from locusweave.cli import parser

    args = parser().parse_args(argv)
    assert args.genome_id == "x"


def test_checks_of_the_registry_find_something(spark):
    for name in ("drop_all_duplicates", "chrom_set_diff", "strand_check", "null_rows"):
        assert not QUERIES[name](spark, "/root/testdata/sf0.01").isEmpty()
