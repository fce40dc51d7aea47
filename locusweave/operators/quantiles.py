"""Exact order statistics and samples of large tables by repeated histograms; no task holds all values, no global sort."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Parts that a histogram divides a range of values into, and values that are few enough to be looked at one by one.
PARTS, FEW = 1 << 12, 1 << 14


def _ranked(rows: DataFrame, column: str, wanted: Sequence[int]) -> dict[int, float]:
    """The values at places `wanted` (from 0) of the sorted column."""
    found: dict[int, float] = {}
    ends = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    ranges = [(ends["low"], ends["high"], 0, list(wanted))]  # low, high, values before, places that lie in it
    while ranges:
        low, high, before, places = ranges.pop()
        here = rows.where((F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)))
        # the part of a value grows with the value, whatever rounding does to it
        part = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit((high - low) / PARTS)), F.lit(PARTS - 1)) if high > low and (high - low) / PARTS > 0 else F.lit(0)
        parts = here.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(column).alias("a"), F.max(column).alias("b")).collect()  # PARTS rows at most
        for p in sorted(parts, key=lambda r: r["a"]):
            inside = [k for k in places if before <= k < before + p["n"]]
            if inside and p["a"] == p["b"]:
                found |= dict.fromkeys(inside, p["a"])
            elif inside and (p["n"] <= FEW or (p["a"], p["b"]) == (low, high)):
                values = here.where((F.col(column) >= F.lit(p["a"])) & (F.col(column) <= F.lit(p["b"]))).groupBy(column).agg(F.count("*").alias("n"))
                at = before
                for v in sorted(values.collect(), key=lambda r: r[0]):
                    found |= {k: v[0] for k in inside if at <= k < at + v["n"]}
                    at += v["n"]
            elif inside:
                ranges.append((p["a"], p["b"], before, inside))
            before += p["n"]
    return found


def exact_quantiles(rows: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """The interpolated quantiles of a numeric column, exact; None of no values. Nulls and NaN take no part.

    A histogram of PARTS counts shows in which part a quantile lies; that part is divided again, until it holds one value or few
    rows. Each round reads the column once and returns at most PARTS rows, so give a stored table.
    """
    rows = rows.select(F.col(column).cast("double").alias(column)).where(F.col(column).isNotNull() & ~F.isnan(column))
    n = rows.count()
    if not n:
        return [None] * len(shares)
    spots = [(n - 1) * s for s in shares]
    found = _ranked(rows, column, sorted({k for s in spots for k in (math.floor(s), math.ceil(s))}))
    low = [found[math.floor(s)] for s in spots]
    return [a + (found[math.ceil(s)] - a) * (s - math.floor(s)) for a, s in zip(low, spots, strict=True)]


def grouped_medians(rows: DataFrame, by: str, column: str) -> DataFrame:
    """(by, median) of whole numbers per group, exact and interpolated; null groups and values are left out.

    Equal values are counted first; running counts over them, in ranges of values, tell where the middle lies. The rows of a group
    are never together, however many it has.
    """
    counts = rows.where(F.col(by).isNotNull() & F.col(column).isNotNull()).groupBy(by, F.col(column).alias("v")).agg(F.count("*").alias("n"))
    # ranges of values by their leading bits: at most 64 times 2**10 in a group
    counts = counts.withColumn("r", F.expr("cast(sign(v) as int) * (length(bin(abs(v))) * 4096 + shiftright(abs(v), greatest(length(bin(abs(v))) - 11, 0)))"))
    ranges = counts.groupBy(by, "r").agg(F.sum("n").alias("in_range"))
    ranges = ranges.withColumn("before", F.coalesce(F.sum("in_range").over(W.partitionBy(by).orderBy("r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    ranges = ranges.withColumn("all", F.sum("in_range").over(W.partitionBy(by)))
    low, high = F.expr("(all - 1) div 2"), F.expr("all div 2")
    middle = ranges.where((F.col("before") <= high) & (F.col("before") + F.col("in_range") > low))
    inside = counts.join(middle.select(by, "r", "before", "all"), [by, "r"])
    upto = F.col("before") + F.sum("n").over(W.partitionBy(by, "r").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    inside = inside.withColumn("upto", upto)
    at = lambda k: F.max(F.when((F.col("upto") - F.col("n") <= k) & (F.col("upto") > k), F.col("v")))
    return inside.groupBy(by).agg(((at(low) + at(high)) / F.lit(2.0)).alias("median"))


def hash_sample(rows: DataFrame, n: int, name: str, bits: int = 12) -> DataFrame:
    """The n rows that stand first by (md5 of the name, name): the same ones on every run and cluster, without sorting the table.

    A histogram over the leading bits of the hash tells the bucket in which the n-th row lies; buckets before it are taken whole,
    and only its own rows are ranked. Where one bucket is large, further bits divide it. All rows, if there are no more than n.
    """
    hashed = rows.withColumn("__hash", F.md5(F.col(name).cast("string")))
    taken, prefix, left = F.lit(False), "", n
    while True:
        digits = len(prefix) + bits // 4
        here = hashed.where(F.col("__hash").startswith(prefix)) if prefix else hashed
        counts = sorted((r["p"], r["n"]) for r in here.groupBy(F.substring("__hash", 1, digits).alias("p")).agg(F.count("*").alias("n")).where("p IS NOT NULL").collect())  # 2**bits rows at most
        cut = None
        for p, k in counts:
            if k > left:
                cut = (p, k)
                break
            left -= k
        whole = F.substring("__hash", 1, digits) < F.lit(cut[0]) if cut else F.lit(True)
        taken = taken | ((F.col("__hash").startswith(prefix) & whole) if prefix else whole)
        if not cut or not left:
            return hashed.where(taken & F.col("__hash").isNotNull()).drop("__hash")
        prefix = cut[0]
        if cut[1] <= FEW or digits >= 32:
            break
    rank = F.row_number().over(W.partitionBy(F.substring("__hash", 1, len(prefix))).orderBy("__hash", name))
    last = hashed.where(F.col("__hash").startswith(prefix)).withColumn("__rank", rank).where(F.col("__rank") <= left)
    return hashed.where(taken).unionByName(last.drop("__rank")).drop("__hash")
