"""The density cube: overlapping base pairs per gene, direction, window and category, over the region's length."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.operators.coverage import region_bases, region_counts
from locusweave.operators.regions import region_sql, structs
from locusweave.schema import DOWNSTREAM, INTRA, LEFT, ORDER, RIGHT, SUPERFAMILY, UPSTREAM

BOTH = (ORDER, SUPERFAMILY)


def categories(kinds: Sequence[str] = BOTH) -> Column:
    columns = {ORDER: "te_order", SUPERFAMILY: "superfamily"}
    return F.array(*(F.struct(F.lit(k).alias("te_category"), F.col(columns[k]).alias("te_name")) for k in kinds))


def overlap_counts(genes: DataFrame, intervals: DataFrame, windows: Iterable[int], direction: str) -> DataFrame:
    """(chrom, gene_name, window, n, bp): how many intervals a region meets and how many bases it shares with them, where there are any.

    Both are differences of running sums (see coverage.py): no pair of a gene and an interval is made, as these grow with the product.
    """
    cells = region_sql(windows, (direction,))
    rows = genes.dropna(subset=["chrom", "start", "stop"])
    met = region_counts(rows, ["chrom", "gene_name"], [(c["r_start"], c["r_stop"]) for c in cells], intervals)
    spread_out = F.expr(structs([{"window": c["window"], "n": f"n_{k}", "bp": f"bases_{k}"} for k, c in enumerate(cells)]))
    return met.select("chrom", "gene_name", F.explode(spread_out).alias("c")).select("chrom", "gene_name", "c.*").where("n > 0")


def names_by_chromosome(rows: DataFrame, kinds: Sequence[str] = BOTH) -> DataFrame:
    """The category names that occur on each chromosome. Rows that a union drops for a null give none."""
    kept = rows.dropna(subset=["chrom", "start", "stop", "te_order", "superfamily"]).select("chrom", "te_order", "superfamily").distinct()
    return kept.select("chrom", F.explode(categories(kinds)).alias("c")).select("chrom", "c.te_category", "c.te_name").distinct()


GENE = ["chrom", "gene_name", "strand", "start", "stop", "length"]


#: Separates category and name in a label; neither holds it.
_MARK = "\x1f"


def _labels(kinds: Sequence[str]) -> Column:
    columns = {ORDER: "te_order", SUPERFAMILY: "superfamily"}
    return F.array_compact(F.array(*(F.concat(F.lit(k + _MARK), F.col(columns[k])) for k in kinds)))


def cell_sums(genes: DataFrame, revised: DataFrame, windows: Iterable[int], directions: Iterable[str], kinds: Sequence[str]) -> DataFrame:
    """A row per gene and name of its chromosome with the shared bases of each region of region_sql as a column, bases_0 and on."""
    cells = region_sql(windows, directions)
    genes = genes.select(*GENE).dropna(subset=["chrom", "start", "stop"])
    summed = region_bases(genes, GENE, [(c["r_start"], c["r_stop"]) for c in cells], revised, _labels(kinds))
    label = F.split("name", _MARK, 2)
    return summed.select(*GENE, label[0].alias("te_category"), label[1].alias("te_name"), *(f"bases_{k}" for k in range(len(cells))))


def spread(summed: DataFrame, windows: Iterable[int], directions: Iterable[str]) -> DataFrame:
    """A row per cell of the rows of cell_sums, with its divisor and density."""
    cells = region_sql(windows, directions)
    parts = F.expr(structs([{n: c[n] for n in ("direction", "window", "divisor")} | {"overlap_bp": f"bases_{k}"} for k, c in enumerate(cells)]))
    rows = summed.select(*GENE, "te_category", "te_name", F.explode(parts).alias("cell"))
    rows = rows.select("chrom", "gene_name", "cell.direction", "cell.window", "strand", "cell.divisor", "te_category", "te_name", "cell.overlap_bp")
    return rows.withColumn("density", F.col("overlap_bp").cast("double") / F.col("divisor"))


def sparse_density(genes: DataFrame, revised: DataFrame, windows: Iterable[int], directions=(LEFT, INTRA, RIGHT), kinds: Sequence[str] = BOTH) -> DataFrame:
    """Cells with at least one base of overlap: the form to store."""
    return dense_density(genes, revised, windows, directions, kinds).where("overlap_bp > 0")


def dense_density(genes: DataFrame, revised: DataFrame, windows: Iterable[int], directions=(LEFT, INTRA, RIGHT), kinds: Sequence[str] = BOTH) -> DataFrame:
    """The full cube: every gene, direction and window for every name of its chromosome, 0 where nothing overlaps.

    One row per gene and name is computed and shuffled, by running sums of covered bases (see coverage.py); cells are spread
    from it last. The cost hardly depends on windows and not at all on how many intervals they hold.
    """
    windows, directions = list(windows), list(directions)
    return spread(cell_sums(genes, revised, windows, directions, kinds), windows, directions)


def mean_densities(genes: DataFrame, revised: DataFrame, windows: Iterable[int], directions=(LEFT, INTRA, RIGHT), kinds: Sequence[str] = BOTH) -> DataFrame:
    """The mean density of all genes per category, name, stranded direction and window.

    Densities are added up per name and strand while a gene is still one row; only these sums are spread to cells, so the cube
    itself is never made.
    """
    cells = region_sql(windows, directions)
    summed = cell_sums(genes, revised, windows, directions, kinds)
    parts = [p for k, c in enumerate(cells) for p in (f"sum(double(bases_{k}) / {c['divisor']}) AS sum_{k}", f"count({c['divisor']}) AS n_{k}")]
    minus = F.coalesce(F.col("strand") == "-", F.lit(False)).alias("minus")
    few = summed.groupBy(minus, "te_category", "te_name").agg(*map(F.expr, parts))
    spread_out = F.expr(structs([{"direction": c["direction"], "window": c["window"], "total": f"sum_{k}", "n": f"n_{k}"} for k, c in enumerate(cells)]))
    rows = few.select("minus", "te_category", "te_name", F.explode(spread_out).alias("c")).select(F.when(F.col("minus"), "-").otherwise("+").alias("strand"), "te_category", "te_name", "c.*")
    return stranded(rows).groupBy("te_category", "te_name", "direction", "window").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("mean_density"))


def stranded(cube: DataFrame) -> DataFrame:
    """Left and right become upstream and downstream as the gene's strand says; no row moves."""
    minus = F.col("strand") == "-"
    up = F.when(minus, RIGHT).otherwise(LEFT)
    name = F.when(F.col("direction") == INTRA, INTRA).when(F.col("direction") == up, UPSTREAM).otherwise(DOWNSTREAM)
    return cube.withColumn("direction", name)


def without_revisions(cube: DataFrame) -> DataFrame:
    return cube.where(~F.col("te_name").contains("Revision"))
