"""Questions to the density cube."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.functions import checks
from locusweave.operators import quantiles
from locusweave.operators.union import STRETCH, stretch_number
from locusweave.schema import DOWNSTREAM, INTRA, ORDER, SUPERFAMILY, UPSTREAM


log = logging.getLogger(__name__)


def check_slice(direction: str, te_category: str, window: int | None, windows: Sequence[int]) -> None:
    if direction not in (UPSTREAM, INTRA, DOWNSTREAM):
        raise ValueError(f"unknown direction {direction!r}")
    if te_category not in (ORDER, SUPERFAMILY):
        raise ValueError(f"unknown category {te_category!r}")
    if (direction == INTRA) != (window is None):
        raise ValueError("a window goes with Upstream and Downstream, none with Intra")
    if window is not None and window not in windows:
        raise ValueError(f"window {window} is not one of {list(windows)}")


def density_slice(cube: DataFrame, te_category: str, te_name: str, direction: str, window: int | None, windows: Sequence[int], names: DataFrame | None = None) -> DataFrame:
    """The rows of one (category, name, direction, window) of a stranded cube; ValueError for what it does not have.

    `names` (te_category, te_name), such as names_by_chromosome gives them, spare a look for the name in the cube.
    """
    check_slice(direction, te_category, window, windows)
    require_name(cube if names is None else names, te_category, te_name)
    same = F.col("window").eqNullSafe(F.lit(window).cast("bigint"))
    return cube.where((F.col("te_category") == te_category) & (F.col("te_name") == te_name) & (F.col("direction") == direction) & same)


def require_name(cube: DataFrame, te_category: str, te_name: str) -> None:
    """ValueError if no row of the cube bears the name."""
    if cube.where((F.col("te_category") == te_category) & (F.col("te_name") == te_name)).isEmpty():
        raise ValueError(f"the cube has no {te_category} {te_name!r}")


def gene(rows: DataFrame, name: str) -> DataFrame:
    """The rows of one gene; KeyError if there are none."""
    found = rows.where(F.col("gene_name") == name)
    if found.isEmpty():
        raise KeyError(name)
    return found


def require_genes(rows: DataFrame, names: DataFrame) -> None:
    """KeyError if a wanted gene_name is in no row."""
    lost = [r[0] for r in checks.missing(names, rows).take(5)]
    if lost:
        raise KeyError(lost)


def reindex(rows: DataFrame, keys: DataFrame, by: str = "gene_name") -> DataFrame:
    """A row for every key, with nulls where there was none; rows of other keys go. `keys` may carry a position to sort by."""
    return keys.join(rows, by, "left")


def dimension(cube: DataFrame, axis: str) -> DataFrame:
    """The distinct values of an axis and their places by order, from 0; axes are windows, names or directions: few."""
    values = cube.select(axis).distinct().where(F.col(axis).isNotNull())
    return values.withColumn("place", F.row_number().over(W.orderBy(axis)) - 1)


def register_views(genes: DataFrame, tes: DataFrame, cube: DataFrame) -> None:
    """The tables by name, for questions in SQL."""
    for name, rows in (("genes", genes), ("tes", tes), ("density", cube)):
        rows.createOrReplaceTempView(name)


def gene_index(genes: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Position of each gene among those of its chromosome, by (start, gene_name), from 0.

    Genes are counted per stretch of the chromosome and the counts added up along it; a task only sorts a stretch.
    """
    rows = genes.withColumn("__stretch", F.coalesce(stretch_number("start", stretch), F.lit(-(1 << 62))))
    along = W.partitionBy("chrom").orderBy("__stretch").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy("chrom", "__stretch").agg(F.count("*").alias("__n"))
    counts = counts.select(F.col("chrom").alias("__chrom"), F.col("__stretch").alias("__s"), F.coalesce(F.sum("__n").over(along), F.lit(0)).alias("__before"))
    inside = F.row_number().over(W.partitionBy("chrom", "__stretch").orderBy("start", "gene_name"))
    placed = rows.withColumn("__place", inside).join(counts, F.col("chrom").eqNullSafe(F.col("__chrom")) & (F.col("__stretch") == F.col("__s")))
    return placed.select(*genes.columns, (F.col("__before") + F.col("__place") - 1).cast("bigint").alias("gene_index"))


def column_name(te_name: str, direction: str, window: int | None) -> str:
    return f"{te_name}_{INTRA}" if direction == INTRA else f"{te_name}_{window}_{direction}"


def append_columns(genes: DataFrame, cube: DataFrame, wanted: Sequence[tuple[str, str, str, int | None]], names: DataFrame | None = None) -> DataFrame:
    """Adds one column per (category, name, direction, window) to the gene table, 0 where the chromosome lacks the name.

    One conditional aggregate makes them all, instead of a join per column. A column of a name that occurs nowhere is 0
    throughout; if `names` (te_category, te_name) are given, such a name is logged.
    """
    if names is not None:
        there = {(r[0], r[1]) for r in names.where(F.col("te_name").isin([n for _, n, *_ in wanted])).select("te_category", "te_name").distinct().collect()}
        for category, name, *_ in wanted:
            if (category, name) not in there:
                log.warning("there is no %s %r: its column is 0", category, name)
    picks = []
    for category, name, direction, window in wanted:
        here = (F.col("te_category") == category) & (F.col("te_name") == name) & (F.col("direction") == direction) & F.col("window").eqNullSafe(F.lit(window).cast("bigint"))
        picks.append((column_name(name, direction, window), here))
    rows = cube.where(reduce(lambda a, b: a | b, [p for _, p in picks]))
    wide = rows.groupBy("chrom", "gene_name").agg(*(F.max(F.when(p, F.col("density"))).alias(n) for n, p in picks))
    return genes.join(wide, ["chrom", "gene_name"], "left").fillna(0.0, [n for n, _ in picks])


def all_slices(cube: DataFrame) -> DataFrame:
    """Every upstream and downstream slice, without the artefact names."""
    return cube.where((F.col("direction") != INTRA) & ~F.col("te_name").contains("Revision"))


def top_bottom(cube: DataFrame, window: int, n: int = 5) -> DataFrame:
    """Per gene, category and direction the n densest and n least dense names; ties by name.

    One pass: both places are found on one partitioning, and a row that stands in both lists is given twice.
    """
    rows = cube.where((F.col("direction") == INTRA) | (F.col("window") == window))
    by = W.partitionBy("chrom", "gene_name", "te_category", "direction")
    rows = rows.withColumn("__top", F.row_number().over(by.orderBy(F.desc("density"), "te_name"))).withColumn("__bottom", F.row_number().over(by.orderBy("density", "te_name")))
    end = lambda c, label: F.when(F.col(c) <= n, F.struct(F.col(c).alias("place"), F.lit(label).alias("end")))
    ends = F.array_compact(F.array(end("__top", "top"), end("__bottom", "bottom")))
    return rows.select(*cube.columns, F.explode(ends).alias("__e")).select(*cube.columns, "__e.place", "__e.end")


def differences_within(pairs: DataFrame, cube: DataFrame) -> DataFrame:
    """paired_differences where both genes are of one cube: the cube is made once.

    Its rows are gathered to one per gene, with a map from (category, name, direction, window) to the density, and only for genes
    that are in a pair; then two joins by gene name complete each pair.
    """
    wanted = pairs.select(F.explode(F.array("gene_a", "gene_b")).alias("gene_name")).distinct()
    cell = F.struct("te_category", "te_name", "direction", "window")
    rows = cube.join(wanted, "gene_name", "left_semi").groupBy("gene_name").agg(F.collect_list(F.struct(cell.alias("cell"), F.col("density").alias("density"))).alias("cells"))
    sides = pairs.select("gene_a", "gene_b", F.monotonically_increasing_id().alias("__pair"))
    both = sides.select("__pair", "gene_a", "gene_b", F.explode(F.array(F.struct(F.col("gene_a").alias("g"), F.lit("a").alias("side")), F.struct(F.col("gene_b").alias("g"), F.lit("b").alias("side")))).alias("x"))
    met = both.select("__pair", "gene_a", "gene_b", F.col("x.side").alias("side"), F.col("x.g").alias("gene_name")).join(rows, "gene_name")
    cells = met.select("__pair", "gene_a", "gene_b", "side", F.explode("cells").alias("c")).select("__pair", "gene_a", "gene_b", "side", "c.cell", "c.density")
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("density")))
    has = lambda s: F.count_if(F.col("side") == s)
    diff = cells.groupBy("__pair", "gene_a", "gene_b", "cell").agg((side("a") - side("b")).alias("difference"), has("a").alias("in_a"), has("b").alias("in_b")).where("in_a > 0 AND in_b > 0")
    return diff.select("gene_a", "gene_b", "cell.*", "difference")


def paired_differences(pairs: DataFrame, cube_a: DataFrame, cube_b: DataFrame, check: bool = False) -> DataFrame:
    """density of gene_a minus that of gene_b for each pair (gene_a, gene_b), per name, window and direction.

    With `check`, cubes of other names, windows or directions are an error, as are pairs whose gene is in no cube.
    """
    if check:
        checks.same_axes(cube_a, cube_b)
        for cube, side in ((cube_a, "gene_a"), (cube_b, "gene_b")):
            require_genes(cube, pairs.select(F.col(side).alias("gene_name")))
    key = ["te_category", "te_name", "direction", "window"]
    a = cube_a.select(F.col("gene_name").alias("gene_a"), *key, F.col("density").alias("density_a"))
    b = cube_b.select(F.col("gene_name").alias("gene_b"), *(F.col(k).alias(f"b_{k}") for k in key), F.col("density").alias("density_b"))
    same = (F.col("window").eqNullSafe(F.col("b_window"))) & (F.col("te_category") == F.col("b_te_category")) & (F.col("te_name") == F.col("b_te_name")) & (F.col("direction") == F.col("b_direction"))
    joined = pairs.join(a, "gene_a").join(b, "gene_b").where(same)
    return joined.select("gene_a", "gene_b", *key, (F.col("density_a") - F.col("density_b")).alias("difference"))


def outliers(rows: DataFrame, column: str, share: float = 0.99) -> DataFrame:
    """Rows at or over the interpolated percentile, which is exact; `rows` are read several times: give a stored table."""
    (edge,) = quantiles.exact_quantiles(rows, column, [share])
    return rows.where(F.col(column) >= F.lit(edge))


def inside_boundaries(genes: DataFrame, boundaries: DataFrame) -> DataFrame:
    """within_boundary = 'Y' where one of the chromosome's boundaries (few, given by hand) holds the whole gene."""
    b = boundaries.groupBy("chrom").agg(F.collect_list(F.struct("b_start", "b_stop")).alias("bounds"))
    holds = F.exists("bounds", lambda x: (F.col("start") >= x["b_start"]) & (F.col("stop") <= x["b_stop"]))
    flagged = genes.join(b, "chrom", "left").withColumn("within_boundary", F.when(F.coalesce(holds, F.lit(False)), "Y").otherwise("N"))
    return flagged.drop("bounds")
