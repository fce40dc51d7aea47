"""Operator 10: quality rules, a threshold table compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, table, text_of

SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "a and are as at be by for from in is it of on or that the this to was with "  # English
    "au avec dans de des du en est et la le les par pas pour que qui sur un une "  # French
    "al con del el es las lo los no para por se su "  # Spanish
    "als auf das dem den der die ein eine im ist mit nicht sich und von zu"  # German
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails when `metric` is below `least` or above `most`."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


#: The threshold table. Every ratio is per word or per line of the whole text.
RULES = (
    Rule("length", "n_words", least=50),
    Rule("word_length", "mean_word_chars", least=2.0, most=12.0),
    Rule("symbols", "symbol_ratio", most=0.10),
    Rule("shouting", "upper_ratio", most=0.40),
    Rule("exclamations", "exclamation_ratio", most=0.30),
    Rule("stop_words", "stop_ratio", least=0.02),
    Rule("lines", "dup_line_ratio", most=0.50),
    Rule("repetition", "repeat_ratio", most=0.50),
)


#: Up to so many repeated windows of a text are looked up one by one; more are found by a sort.
FEW = 16


def _repeated(words: str, grams: str) -> Column:
    """Positions of `words` that lie in a 3-word window found twice or more. `grams`: the windows' hashes, by start.

    A text without equal hashes is done at once. Otherwise the windows whose hash recurs are sorted as (hash, start), which
    puts equal windows side by side; neighbours count when their words are the same too.
    """
    m = F.size(grams)
    same = lambda i, j: (
        (F.get(words, i) == F.get(words, j)) & (F.get(words, i + 1) == F.get(words, j + 1)) & (F.get(words, i + 2) == F.get(words, j + 2))
    )
    ordered = F.sort_array(grams)
    again = F.array_distinct(
        F.array_compact(F.zip_with(F.slice(ordered, 1, m - 1), F.slice(ordered, 2, m - 1), lambda a, b: F.when(a == b, a)))
    )
    pairs = F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    pairs = F.when(F.size("__again") <= FEW, F.filter(pairs, lambda x: F.array_contains("__again", x["h"]))).otherwise(pairs)
    pairs, k = F.sort_array(pairs), F.size("__pairs")
    starts = F.flatten(
        F.zip_with(
            F.slice("__pairs", 1, k - 1),
            F.slice("__pairs", 2, k - 1),
            lambda a, b: F.when((a["h"] == b["h"]) & same(a["i"], b["i"]), F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
        )
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))
    unique = (m < 2) | (F.size(F.array_distinct(grams)) == m)
    return (
        ("__again", F.when(unique, F.array().cast("array<bigint>")).otherwise(again)),
        ("__pairs", F.when(F.size("__again") > 0, pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))),
        ("n_repeat_words", F.when(F.size("__again") > 0, covered).otherwise(0).cast("long")),
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts and ratios that the rules speak of. A null text counts as empty; ratios of an empty text are 0."""
    per = lambda x, n: F.when(F.col(n) > 0, F.col(x) / F.col(n)).otherwise(F.lit(0.0))
    t = text_of(text)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    hashes = F.transform(
        F.slice("__words", 1, F.greatest(F.size("__words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("__words", i + 1), F.get("__words", i + 2)),
    )
    out = docs.withColumn("__words", F.array_remove(F.split(t, f"{SPACE}+"), "")).withColumn("n_words", F.size("__words").cast("long"))
    out = out.withColumn("__grams", F.when(F.col("n_words") < 3, F.array().cast("array<bigint>")).otherwise(hashes))
    for name, column in _repeated("__words", "__grams"):
        out = out.withColumn(name, column)
    return (
        out.withColumn("word_chars", (F.length(t) - F.regexp_count(t, F.lit(SPACE))).cast("long"))
        .withColumn("n_symbols", F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long"))
        .withColumn("__lines", lines)
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("__stop", F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS))))
        .withColumn("__bangs", F.regexp_count(t, F.lit("!")))
        .withColumn("__upper", F.regexp_count(t, F.lit("[A-ZÀ-ÖØ-Þ]")))
        .withColumn("mean_word_chars", per("word_chars", "n_words"))
        .withColumn("symbol_ratio", per("n_symbols", "n_words"))
        .withColumn("upper_ratio", per("__upper", "word_chars"))
        .withColumn("exclamation_ratio", per("__bangs", "n_words"))
        .withColumn("stop_ratio", per("__stop", "n_words"))
        .withColumn("dup_line_ratio", per("n_dup_lines", "n_lines"))
        .withColumn("repeat_ratio", per("n_repeat_words", "n_words"))
        .drop("__words", "__grams", "__again", "__pairs", "__lines", "__stop", "__bangs", "__upper")
    )


def compile_rules(rules=RULES) -> Column:
    """The names of the rules that a measured row fails, as one array expression."""
    out = []
    for r in rules:
        bad = F.lit(False)
        if r.least is not None:
            bad = bad | (F.col(r.metric) < r.least)
        if r.most is not None:
            bad = bad | (F.col(r.metric) > r.most)
        out.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*out))


def apply_rules(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """Per row: its counts, base_failed, failed_rules and kept.

    Null and empty texts have no words and fail the length rule. Repeated rows are judged alike, each on its own; an empty
    table gives an empty result. Texts of any length are measured whole, in memory of a few times their own. Columns of the input
    that bear the name of a measure are replaced by the measure.
    """
    return (
        measure(docs, text)
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .withColumn("failed_rules", compile_rules(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d
), u AS (
  SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS a FROM w
), g AS (
  SELECT r, i, a, lead(a, 1) OVER (PARTITION BY r ORDER BY i) AS b, lead(a, 2) OVER (PARTITION BY r ORDER BY i) AS c FROM u
), h AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g WHERE c IS NOT NULL
), c AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM h WHERE n > 1) GROUP BY r
), m AS (
  SELECT w.*, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]+', '', 'g')) AS upper,
    len(list_filter(ws, lambda x: list_contains([{_STOP}], lower(x)))) AS n_stop,
    length(t) - length(replace(t, '!', '')) AS bangs
  FROM w LEFT JOIN c USING (r)
), k AS (
  SELECT *, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND CAST(word_chars AS DOUBLE) / greatest(n_words, 1) BETWEEN 2.0 AND 12.0
  AND CAST(n_symbols AS DOUBLE) / greatest(n_words, 1) <= 0.10
  AND CAST(upper AS DOUBLE) / greatest(word_chars, 1) <= 0.40
  AND CAST(bangs AS DOUBLE) / greatest(n_words, 1) <= 0.30
  AND CAST(n_stop AS DOUBLE) / greatest(n_words, 1) >= 0.02
  AND CAST(n_dup_lines AS DOUBLE) / greatest(len(ls), 1) <= 0.50
  AND CAST(n_repeat_words AS DOUBLE) / greatest(n_words, 1) <= 0.50 AS kept
FROM k
"""
