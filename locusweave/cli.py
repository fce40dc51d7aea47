"""python -m locusweave.cli GENES TES GENOME_ID: revises the annotation and writes the density table."""

from __future__ import annotations

import argparse
import hashlib
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from locusweave.functions import checks
from locusweave.operators.density import dense_density, sparse_density
from locusweave.operators.union import revise
from locusweave.schema import PRODUCTION_WINDOWS
from locusweave.sources import annotations, sinks
from locusweave.sources.store import put_text


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("genes_input_file")
    p.add_argument("tes_input_file")
    p.add_argument("genome_id")
    p.add_argument("--config_file", "-c", help="INI file with first_window_size, window_delta and last_window_size")
    p.add_argument("--output_dir", "-o", default="densities")
    p.add_argument("--num_threads", "-n", type=int, help="local cores, where no master is set")
    p.add_argument("--revise_anno", action="store_true", help="revise again even if a revised annotation is there")
    p.add_argument("--reset_h5", "--recompute", dest="recompute", action="store_true", help="compute the density again even if it is there")
    p.add_argument("--genes_list", help="file with a gene name a line: the density of these only; unknown ones are logged and skipped")
    p.add_argument("--sparse", action="store_true", help="leave cells without overlap out")
    p.add_argument("--single_process", action="store_true")
    p.add_argument("--verbose", "-v", action="store_true")
    return p


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end: its mark comes last."""
    return _there(spark, f"{path}/_COMPLETE")


def require_files(spark: SparkSession, *paths: str) -> None:
    """FileNotFoundError for what is not there, before a reader complains in its own way."""
    for path in paths:
        if not _there(spark, path):
            raise FileNotFoundError(path)


def run_key(spark: SparkSession, inputs: Sequence[str], settings: Sequence[object] = ()) -> str:
    """A short digest of the input files (paths, sizes, times of change) and the settings that a stored table depends on."""
    files = []
    for path in inputs:
        for r in annotations.list_files(spark, path).collect():
            files.append((r["path"], r["length"], str(r["modificationTime"])))
    return hashlib.sha256(repr((sorted(files), [str(s) for s in settings])).encode()).hexdigest()[:16]


def main(argv: list[str] | None = None) -> str:
    """Returns the folder of the density table. Tables of other inputs, windows or modes have folders of their own, so that a
    stored table is only used again for what it was made from."""
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    builder = SparkSession.builder.appName("locusweave")
    if args.single_process or args.num_threads:
        builder = builder.master(f"local[{1 if args.single_process else args.num_threads}]")
    spark = builder.getOrCreate()
    require_files(spark, args.genes_input_file, args.tes_input_file, *([args.genes_list] if args.genes_list else []))
    windows = annotations.windows_from_ini(args.config_file) if args.config_file else PRODUCTION_WINDOWS
    genes, tes = annotations.read_genes(spark, args.genes_input_file), annotations.read_tes(spark, args.tes_input_file)
    checks.validate(genes, tes)
    genome = F.lit(args.genome_id)
    base, mode = f"{args.output_dir}/{args.genome_id}", "sparse" if args.sparse else "dense"
    revised_path = f"{base}/revised/{run_key(spark, [args.tes_input_file])}"
    inputs = [args.genes_input_file, args.tes_input_file, *([args.genes_list] if args.genes_list else [])]
    density_path = f"{base}/density/{run_key(spark, inputs, [*windows, mode])}"
    if args.genes_list:
        known = checks.known_only(annotations.read_names(spark, args.genes_list), genes)
        genes = genes.join(known, "gene_name", "left_semi").select(*genes.columns)
    if args.revise_anno or not exists(spark, revised_path):
        sinks.write_cache(revise(tes).withColumn("genome_id", genome), revised_path)
        put_text(spark, f"{revised_path}/_COMPLETE", "")
    if args.recompute or args.revise_anno or not exists(spark, density_path):
        make = sparse_density if args.sparse else dense_density
        sinks.write_density(make(genes, annotations.read_revised(spark, revised_path), windows).withColumn("genome_id", genome), density_path)
        put_text(spark, f"{density_path}/_COMPLETE", "")
    logging.info("density table: %s", density_path)
    return density_path


if __name__ == "__main__":
    main()
