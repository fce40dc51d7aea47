"""Regions around genes: closed intervals left of, inside and right of the gene, and their divisors."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.schema import INTRA, LEFT, RIGHT


log = logging.getLogger(__name__)


def left_divisor(start: Column, window: Column) -> Column:
    """window + 1, but the gene's start where the region is clipped at 0. Null for a gene that starts at 0."""
    return F.nullif(F.when(start - 1 - window <= 0, start).otherwise(window + 1), F.lit(0))


def region_sql(windows: Iterable[int], directions: Iterable[str] = (LEFT, INTRA, RIGHT)) -> list[dict[str, str]]:
    """The regions of a gene in SQL over start, stop and length: direction, window (null inside the gene), r_start, r_stop, divisor.

    Negative windows are skipped, and logged.
    """
    given, directions = {int(w) for w in windows}, set(directions)
    if any(w < 0 for w in given):
        log.error("windows %s are negative and skipped", sorted(w for w in given if w < 0))
    row = lambda d, w, a, b, n: {"direction": f"'{d}'", "window": w, "r_start": a, "r_stop": b, "divisor": f"bigint({n})"}
    out = []
    for w in sorted(w for w in given if w >= 0):
        if LEFT in directions:
            out.append(row(LEFT, f"{w}L", f"greatest(start - {w + 1}, 0)", "start - 1", f"nullif(if(start - {w + 1} <= 0, start, {w + 1}), 0)"))
        if RIGHT in directions:
            out.append(row(RIGHT, f"{w}L", "stop + 1", f"stop + {w + 1}", f"{w + 1}"))
    if INTRA in directions:
        out.append(row(INTRA, "bigint(null)", "start", "stop", "nullif(length, 0)"))
    return out


def structs(cells: list[dict[str, str]]) -> str:
    """The regions as one array of structs; one text, as a column object for each part of each would take longer than the query."""
    return "array(" + ", ".join("named_struct(" + ", ".join(f"'{n}', {c}" for n, c in cell.items()) + ")" for cell in cells) + ")"


def regions(genes: DataFrame, windows: Iterable[int], directions: Iterable[str] = (LEFT, INTRA, RIGHT)) -> DataFrame:
    """One row per gene and region. Genes without a coordinate are left out."""
    kept = genes.dropna(subset=["chrom", "start", "stop"])
    return kept.withColumn("r", F.explode(F.expr(structs(region_sql(windows, directions))))).select(*genes.columns, "r.*")
