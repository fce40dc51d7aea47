"""Bins, descriptive statistics and tests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edges of the ten density bins, as adding up steps of 0.1 gives them.
EDGES = tuple(k * 0.1 for k in range(11))


def bin_label(k: int) -> str:
    return f"{'[' if k == 0 else '('}{round(EDGES[k], 1)} {round(EDGES[k + 1], 1)}]"


def density_bin(value: Column) -> Column:
    """Right-closed bins of 0.1, the first closed on both sides; null outside [0, 1]."""
    out = F.when((value >= EDGES[0]) & (value <= EDGES[1]), bin_label(0))
    for k in range(1, 10):
        out = out.when((value > EDGES[k]) & (value <= EDGES[k + 1]), bin_label(k))
    return out


def count_bins(rows: DataFrame, value: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Genes per bin, empty bins at 0."""
    labels = rows.sparkSession.createDataFrame([(bin_label(k),) for k in range(10)], "bin string")
    frame = F.broadcast(labels) if not by else rows.select(*by).distinct().crossJoin(F.broadcast(labels))
    counts = rows.withColumn("bin", density_bin(value)).where("bin IS NOT NULL").groupBy(*by, "bin").agg(F.count("*").alias("n"))
    return frame.join(counts, [*by, "bin"], "left").fillna(0, ["n"])


def histogram_bin(value: Column, low: float = -1.0, high: float = 1.0, bins: int = 20) -> Column:
    """Number of the left-closed bin from 0; the last one is closed on both sides; null outside."""
    k = F.floor((value - low) / ((high - low) / bins)).cast("int")
    return F.when((value >= low) & (value < high), F.least(k, F.lit(bins - 1))).when(value == high, bins - 1)


def chi_square(observed: list[Column], expected: Column) -> Column:
    return sum(((o - expected) * (o - expected) / expected for o in observed[1:]), (observed[0] - expected) * (observed[0] - expected) / expected)


#: Steps of the continued fraction and terms of the series; more change nothing in double precision for their ranges.
_STEPS, _TERMS = 60, 60


def chi_square_p(statistic: Column) -> Column:
    """Upper tail for one degree of freedom, erfc(sqrt(x / 2)), in built-in functions: a series below 2, a continued fraction above. Null stays null."""
    x = statistic / 2
    # the lower incomplete gamma function of 1/2: exp(-x) sqrt(x) times the sum over k of x^k / ((1/2)(3/2)...(1/2 + k))
    ks = F.sequence(F.lit(1), F.lit(_TERMS))
    start = F.struct(F.lit(2.0).alias("term"), F.lit(2.0).alias("sum"))

    def add(acc, k):
        term = acc["term"] * x / (k + 0.5)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    root = F.lit(math.sqrt(math.pi))
    low = 1 - F.exp(-x) * F.sqrt(x) * F.aggregate(ks, start, add, lambda acc: acc["sum"]) / root
    # the upper one as a fraction from its far end: x + 1/2 / (1 + 1 / (x + 3/2 / (1 + 2 / (x + ...))))
    back = F.sequence(F.lit(_STEPS), F.lit(1), F.lit(-1))
    fraction = F.aggregate(back, x + 0.0, lambda acc, k: x + (k - 0.5) / (1 + k / acc))
    high = F.exp(-x) * F.sqrt(x) / fraction / root
    return F.when(statistic < 2, low).otherwise(high)


def row_mean(columns: list[str]) -> Column:
    """Mean over columns that are not null; null if all are."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns[1:]), F.coalesce(F.col(columns[0]), F.lit(0.0)))
    n = sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int"))
    return F.when(n > 0, total / n)


def lengths_by(rows: DataFrame, by: str) -> DataFrame:
    """Count, sum (also in billions of bases) and mean of lengths per group; rows without a group are left out. Medians: quantiles.grouped_medians."""
    return rows.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count("*").alias("n"), F.sum("length").alias("total"), (F.sum("length") / F.lit(1e9)).alias("total_gb"), F.avg("length").alias("mean")
    )


def genome_size(genes: DataFrame, tes: DataFrame, chromosomes: list[str] | None = None) -> DataFrame:
    """Billions of bases: the furthest stop of any gene or element, summed over the chromosomes."""
    both = genes.select("chrom", "stop").unionByName(tes.select("chrom", "stop"))
    if chromosomes is not None:
        both = both.where(F.col("chrom").isin(chromosomes))
    return both.groupBy("chrom").agg(F.max("stop").alias("stop")).agg((F.sum("stop") / F.lit(1e9)).alias("size_gb"))


def share_at_least(rows: DataFrame, value: str, least: float = 0.5, by: tuple[str, ...] = ()) -> DataFrame:
    return rows.groupBy(*by).agg(F.avg(F.when(F.col(value) >= least, 1.0).otherwise(0.0)).alias("share"))
