"""A virtual genome over the test tables: deterministic and integer only, the same in Spark and in the oracle's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.schema import PRODUCTION_WINDOWS, TOTAL

WINDOWS = tuple(PRODUCTION_WINDOWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes with strands + - and, for one in seven, a dot."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('gene_', p_partkey) AS gene_name", "concat('Chr', p_partkey % 5) AS chrom", "'gene' AS feature",
        "(p_partkey * 4999) % 10000000 + 1 AS start", "(p_partkey * 4999) % 10000000 + 100 + p_size * 20 AS stop",
        "CASE WHEN p_size % 7 = 0 THEN '.' WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand",
        "CAST(p_size * 20 + 100 AS BIGINT) AS length",
    )


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_genes(spark, sf_dir).withColumn("strand", F.when(F.col("strand") == ".", "+").otherwise(F.col("strand")))


def tes(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = "(l_orderkey * 7919 + l_linenumber * 104729) % 10000000"
    order = "CASE l_returnflag WHEN 'A' THEN 'LTR' WHEN 'N' THEN 'TIR' ELSE 'Helitron' END"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('Chr', l_suppkey % 5) AS chrom", f"{at} + 1 AS start", f"{at} + CAST(floor(l_quantity) AS BIGINT) * 10 AS stop",
        "CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand", f"{order} AS te_order", f"concat({order}, '_', l_linestatus) AS superfamily",
        "CAST(floor(l_quantity) AS BIGINT) * 10 AS length",
    )


GENES_SQL = """raw_genes AS (
  SELECT 'gene_' || p_partkey AS gene_name, 'Chr' || (p_partkey % 5) AS chrom, 'gene' AS feature,
    CAST((p_partkey * 4999) % 10000000 + 1 AS BIGINT) AS start, CAST((p_partkey * 4999) % 10000000 + 100 + p_size * 20 AS BIGINT) AS stop,
    CASE WHEN p_size % 7 = 0 THEN '.' WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(p_size * 20 + 100 AS BIGINT) AS length
  FROM part
), genes AS (
  SELECT gene_name, chrom, feature, start, stop, CASE WHEN strand = '.' THEN '+' ELSE strand END AS strand, length FROM raw_genes
)"""
TES_SQL = """tes AS (
  SELECT chrom, p + 1 AS start, p + q AS stop, strand, te_order, te_order || '_' || l_linestatus AS superfamily, q AS length FROM (
    SELECT 'Chr' || (l_suppkey % 5) AS chrom, CAST((l_orderkey * 7919 + l_linenumber * 104729) % 10000000 AS BIGINT) AS p,
      CAST(floor(l_quantity) AS BIGINT) * 10 AS q, CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand,
      CASE l_returnflag WHEN 'A' THEN 'LTR' WHEN 'N' THEN 'TIR' ELSE 'Helitron' END AS te_order, l_linestatus
    FROM lineitem)
)"""
REVISED_SQL = f"""keyed AS (
  SELECT chrom, start, stop, strand, 'S_Revision' AS te_order, superfamily FROM tes
  UNION SELECT chrom, start, stop, strand, te_order, 'O_Revision' FROM tes
  UNION SELECT chrom, start, stop, strand, '{TOTAL}', '{TOTAL}' FROM tes
), reach AS (
  SELECT *, max(stop) OVER (PARTITION BY chrom, te_order, superfamily ORDER BY start, stop, strand ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM keyed
), flagged AS (
  SELECT *, sum(CASE WHEN before IS NULL OR start > before THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, te_order, superfamily ORDER BY start, stop, strand ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM reach
), revised AS (
  SELECT chrom, te_order, superfamily, min(start) AS start, max(stop) AS stop, arg_min(strand, (start, stop, strand)) AS strand, max(stop) - min(start) + 1 AS length
  FROM flagged GROUP BY chrom, te_order, superfamily, island
)"""
REGIONS_SQL = """windows(w) AS (
  SELECT unnest(range(500, 10001, 500))
), regions AS (
  SELECT chrom, gene_name, strand, 'Left' AS direction, w AS "window", greatest(start - 1 - w, 0) AS r_start, start - 1 AS r_stop,
    nullif(CASE WHEN start - 1 - w <= 0 THEN start ELSE w + 1 END, 0) AS divisor FROM genes, windows
  UNION ALL SELECT chrom, gene_name, strand, 'Right', w, stop + 1, stop + 1 + w, w + 1 FROM genes, windows
  UNION ALL SELECT chrom, gene_name, strand, 'Intra', NULL, start, stop, nullif(length, 0) FROM genes
)"""
DENSITY_SQL = """named AS (
  SELECT chrom, start, stop, unnest([{'c': 'Order', 'n': te_order}, {'c': 'Superfamily', 'n': superfamily}]) AS k FROM revised
), names AS (
  SELECT DISTINCT chrom, k.c AS te_category, k.n AS te_name FROM named
), met AS (
  SELECT r.chrom, r.gene_name, r.direction, r."window", k.c AS te_category, k.n AS te_name, CAST(sum(least(r.r_stop, t.stop) - greatest(r.r_start, t.start) + 1) AS BIGINT) AS bp
  FROM regions r JOIN named t ON r.chrom = t.chrom AND t.start <= r.r_stop AND t.stop >= r.r_start
  GROUP BY ALL
), cube AS (
  SELECT r.chrom, r.gene_name, r.direction, r."window", r.strand, r.divisor, n.te_category, n.te_name, coalesce(m.bp, 0) AS overlap_bp,
    CAST(coalesce(m.bp, 0) AS DOUBLE) / r.divisor AS density
  FROM regions r JOIN names n ON r.chrom = n.chrom
  LEFT JOIN met m ON m.chrom = r.chrom AND m.gene_name = r.gene_name AND m.direction = r.direction AND m."window" IS NOT DISTINCT FROM r."window"
    AND m.te_category = n.te_category AND m.te_name = n.te_name
), stranded AS (
  SELECT * REPLACE (CASE WHEN direction = 'Intra' THEN 'Intra' WHEN direction = CASE WHEN strand = '-' THEN 'Right' ELSE 'Left' END THEN 'Upstream' ELSE 'Downstream' END AS direction) FROM cube
)"""


def sql(select: str, *parts: str) -> str:
    """WITH the named parts (and what they build on), then the query."""
    order = {"genes": [GENES_SQL], "tes": [TES_SQL], "revised": [TES_SQL, REVISED_SQL], "regions": [GENES_SQL, REGIONS_SQL], "cube": [GENES_SQL, TES_SQL, REVISED_SQL, REGIONS_SQL, DENSITY_SQL]}
    used = list(dict.fromkeys(x for p in parts for x in order.get(p, [p])))
    return "WITH " + ",\n".join(used) + "\n" + select
