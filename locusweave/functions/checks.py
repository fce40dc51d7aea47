"""Integrity checks: each gives the offending rows; require() turns them into an error."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def bad_strands(rows: DataFrame) -> DataFrame:
    return rows.where(~F.coalesce(F.col("strand").isin("+", "-", "."), F.lit(False)))


def rows_with_nulls(rows: DataFrame) -> DataFrame:
    return rows.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in rows.columns]))


def null_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns))


def repeated_names(genes: DataFrame) -> DataFrame:
    return genes.groupBy("gene_name").agg(F.count("*").alias("n")).where("n > 1")


def drop_all_duplicates(rows: DataFrame, name: str = "gene_name") -> DataFrame:
    """Keeps only rows whose name occurs once. Counts are joined back, so a very common name is not gathered in one task."""
    once = rows.groupBy(name).agg(F.count("*").alias("__n")).where("__n = 1")
    return rows.join(once, rows[name].eqNullSafe(once[name]), "left_semi")


def chromosome_difference(genes: DataFrame, tes: DataFrame) -> DataFrame:
    """Chromosomes that only one of the tables has."""
    a, b = genes.select("chrom").distinct(), tes.select("chrom").distinct()
    return a.exceptAll(b).withColumn("only_in", F.lit("genes")).unionByName(b.exceptAll(a).withColumn("only_in", F.lit("tes")))


def single_genome(rows: DataFrame) -> str:
    """The one genome_id of a table; an error if it has none or several."""
    ids = [r[0] for r in rows.select("genome_id").distinct().limit(2).collect()]
    if len(ids) != 1 or ids[0] is None:
        raise RuntimeError(f"one genome_id is wanted, there are {ids}")
    return ids[0]


def same_content(a: DataFrame, b: DataFrame) -> bool:
    """TypeError if the schemas differ, else whether both hold the same rows."""
    if a.schema.simpleString() != b.schema.simpleString():
        raise TypeError(f"{a.schema.simpleString()} is not {b.schema.simpleString()}")
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def same_axes(a: DataFrame, b: DataFrame, axes: Sequence[str] = ("te_category", "te_name", "direction", "window")) -> None:
    """Two cubes can be compared or joined: TypeError if their columns differ, ValueError if an axis has other values."""
    if sorted(a.dtypes) != sorted(b.dtypes):
        raise TypeError(f"columns {a.dtypes} and {b.dtypes}")
    for axis in axes:
        x, y = a.select(axis).distinct(), b.select(axis).distinct()
        require(x.exceptAll(y).unionByName(y.exceptAll(x)), f"values of {axis} that only one table has")


def missing(names: DataFrame, rows: DataFrame, name: str = "gene_name") -> DataFrame:
    """Names that no row bears."""
    return names.select(name).distinct().join(rows, name, "left_anti")


def known_only(names: DataFrame, rows: DataFrame, name: str = "gene_name") -> DataFrame:
    """The names that some row bears; how many others there were is logged, with the first of them."""
    odd = missing(names, rows, name)
    first = [r[0] for r in odd.take(5)]
    if first:
        log.error("%d names are unknown and skipped, such as %s", odd.count(), first)
    return names.join(rows, name, "left_semi")


def require(offending: DataFrame, what: str) -> None:
    rows = offending.take(5)
    if rows:
        raise ValueError(f"{what}: {[tuple(r) for r in rows]}")


def validate(genes: DataFrame, tes: DataFrame) -> None:
    require(bad_strands(genes), "strands of genes other than + - .")
    require(repeated_names(genes), "gene names that occur more than once")
    require(chromosome_difference(genes, tes), "chromosomes that only one table has")


