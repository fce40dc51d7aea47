"""Overlap join of two tables of closed intervals with equality keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bases of the smallest bins, as a power of two; each further level of the ladder has bins 2**STEP times as large.
SMALLEST, STEP, LEVELS = 13, 1, 50
#: Rows of the right side that one task takes from a bin.
MOST = 100_000


def _bin(position: str, level: str, smallest: int) -> str:
    # the top level is one bin for all
    return f"if({level} = {LEVELS} OR {smallest} + {STEP} * {level} > 62, 0, shiftright({position}, cast({smallest} + {STEP} * {level} as int)))"


def _level(low: str, high: str, smallest: int) -> Column:
    """The lowest level whose bins are at least as long as the interval, which then touches two of them at most."""
    return F.expr(f"least({LEVELS}, greatest(0, cast(ceil((length(bin({high} - {low})) - {smallest}) / {STEP}) as int)))")


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ends: tuple[str, str], right_ends: tuple[str, str], smallest: int = SMALLEST, most: int = MOST) -> DataFrame:
    """Inner join on `keys` and a shared base; adds overlap_bp. Other column names of the sides must differ.

    Bins come in a ladder of sizes, each twice the one before. An interval's own level is the lowest whose bins are not shorter than
    it, so an interval of any length touches one or two bins there. Two intervals meet at the higher of their levels, and are
    kept in the bin where the later of their starts lies. A row only stands at its own level and at higher ones that the other
    side has. A bin that holds over `most` rows of the right side, by a count, is split: its right rows are dealt to
    parts and its left rows go to each. Rows with a null key or end, or that end before they start, meet nothing.
    """
    (a, b), (c, d) = left_ends, right_ends
    ordered = lambda df, lo, hi: df.dropna(subset=[*keys, lo, hi]).where(F.col(hi) >= F.col(lo))
    x = ordered(left, a, b).withColumn("__own_l", _level(a, b, smallest))
    y = ordered(right, c, d).withColumn("__own_r", _level(c, d, smallest))
    seen = x.select(F.lit(0), "__own_l").union(y.select(F.lit(1), "__own_r")).distinct().collect()  # LEVELS + 1 numbers a side at most
    has = [sorted(level for side, level in seen if side == s) for s in (0, 1)]
    levels = F.array(*(F.lit(k) for k in sorted({*has[0], *has[1]}))).cast("array<int>")
    # a row stands at its own level and at the higher levels that rows of the other side have as their own
    at = lambda own, other: F.explode(F.filter(levels, lambda k: (k == F.col(own)) | ((k > F.col(own)) & F.array_contains(F.array(*map(F.lit, other)).cast("array<int>"), k))))
    touched = lambda lo, hi: F.explode(F.expr(f"array_distinct(array({_bin(lo, '__level', smallest)}, {_bin(hi, '__level', smallest)}))"))
    x = x.withColumn("__level", at("__own_l", has[1])).withColumn("__bin", touched(a, b))
    y = y.withColumn("__level", at("__own_r", has[0])).withColumn("__bin", touched(c, d))
    place = [*keys, "__level", "__bin"]
    full = y.groupBy(*place).agg(F.count("*").alias("__n")).where(F.col("__n") > most)
    full = full.select(*place, F.ceil(F.col("__n") / F.lit(most)).cast("int").alias("__parts"))
    y = y.join(full, place, "left").withColumn("__part", F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(c, d, F.monotonically_increasing_id()), F.col("__parts")).cast("int"))).drop("__parts")
    x = x.join(full, place, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    pairs = x.join(y, [*place, "__part"]).where((F.col(c) <= F.col(b)) & (F.col(d) >= F.col(a)) & (F.greatest("__own_l", "__own_r") == F.col("__level")) & (F.col("__bin") == F.expr(_bin(f"greatest({a}, {c})", "__level", smallest))))
    return pairs.drop("__level", "__bin", "__part", "__own_l", "__own_r").withColumn("overlap_bp", F.least(b, d) - F.greatest(a, c) + 1)
