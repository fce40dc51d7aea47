"""Writers: parquet tables, tab-separated files, GFF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.functions import checks

CODECS = ("snappy", "zstd", "gzip", "lz4", "none")


def write_cache(rows: DataFrame, path: str, compression: str = "zstd") -> None:
    """A table partitioned by genome and chromosome; partitions that the rows have are replaced, others stay."""
    if compression not in CODECS:
        raise ValueError(f"compression {compression!r} is not one of {CODECS}")
    by = [c for c in ("genome_id", "chrom") if c in rows.columns]
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression).partitionBy(*by).parquet(path)


write_density = write_cache


def write_tsv(rows: DataFrame, path: str, header: bool = True) -> None:
    rows.write.mode("overwrite").csv(path, sep="\t", header=header)


#: Headers of cleaned tables, which the readers want.
GENE_HEADER = {"gene_name": "Gene_Name", "chrom": "Chromosome", "feature": "Feature", "start": "Start", "stop": "Stop", "strand": "Strand", "length": "Length"}
TE_HEADER = {"chrom": "Chromosome", "start": "Start", "stop": "Stop", "strand": "Strand", "te_order": "Order", "superfamily": "SuperFamily", "length": "Length"}


def write_cleaned_genes(genes: DataFrame, path: str) -> None:
    """A gene table that annotations.read_genes reads."""
    write_tsv(genes.select(*(F.col(c).alias(n) for c, n in GENE_HEADER.items())), path)


def write_cleaned_tes(tes: DataFrame, path: str) -> None:
    """An element table that annotations.read_tes reads."""
    write_tsv(tes.select(*(F.col(c).alias(n) for c, n in TE_HEADER.items())), path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Gene pairs as a tab-separated table with a header, one row a pair: chrom, gene_a, gene_b, e_value as far as there are any, then the other columns."""
    columns = [c for c in ("chrom", "gene_a", "gene_b", "e_value") if c in pairs.columns]
    if not {"gene_a", "gene_b"} <= set(columns):
        raise ValueError(f"pairs want gene_a and gene_b, not {pairs.columns}")
    write_tsv(pairs.select(*columns, *(c for c in pairs.columns if c not in columns)), path)


def append_checked(rows: DataFrame, path: str, axes: Sequence[str] = ("te_category", "te_name", "direction", "window")) -> None:
    """Adds rows to a stored table whose columns and axis values they must share: TypeError or ValueError otherwise."""
    there = rows.sparkSession.read.parquet(path)
    checks.same_axes(there, rows, axes)
    rows.select(*there.columns).write.mode("append").parquet(path)


def gff_rows(tes: DataFrame) -> DataFrame:
    """The nine columns of a GFF; source, score, phase and attributes are constants."""
    return tes.select(
        "chrom", F.lit("Test").alias("source"), F.concat_ws("/", "te_order", "superfamily").alias("feature"), "start", F.col("stop").alias("end"),
        F.lit(".").alias("score"), "strand", F.lit(1).alias("phase"), F.lit("Test").alias("attributes"),
    )


def write_gff(tes: DataFrame, path: str) -> None:
    write_tsv(gff_rows(tes).orderBy("start"), path, header=False)


def write_names(genes: DataFrame, path: str) -> None:
    genes.select("gene_name").write.mode("overwrite").text(path)


def paired_columns(cube: DataFrame, te_category: str, te_name: str, window: int) -> DataFrame:
    """Upstream and downstream density of each gene side by side."""
    rows = cube.where((F.col("te_category") == te_category) & (F.col("te_name") == te_name) & (F.col("window") == window))
    side = lambda d: F.max(F.when(F.col("direction") == d, F.col("density")))
    return rows.groupBy("chrom", "gene_name").agg(side("Upstream").alias("upstream"), side("Downstream").alias("downstream"))
