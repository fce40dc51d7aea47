"""The registered queries of the interval engine, each with the SQL that it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.functions import checks, names
from locusweave.operators import density, quantiles, query, stats
from locusweave.operators.regions import regions
from locusweave.operators.union import interval_union, order_rows, revise, revision_rows, superfamily_rows, total_rows
from locusweave.plans.genome import WINDOWS, genes, raw_genes, sql, table, tes
from locusweave.schema import INTRA, LEFT, ORDER, RIGHT, SUPERFAMILY, TOTAL
from locusweave.sources import annotations, sinks
from locusweave.sources.store import stored

_KEYS = ["chrom", "te_order", "superfamily"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query_of(oracle: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def _revised(spark, d) -> DataFrame:
    return revise(tes(spark, d))


BOTH = (ORDER, SUPERFAMILY)
#: What a question may need of the revision: all three unions, or one of them.
PARTS = {"all": revision_rows, "orders": order_rows, "total": total_rows}


def _stored_revision(spark, d, part="all") -> DataFrame:
    return stored(interval_union(PARTS[part](tes(spark, d)), _KEYS), "revised")


def _cube(spark, d, directions=(LEFT, INTRA, RIGHT), windows=WINDOWS, part="all", kinds=BOTH) -> DataFrame:
    """The cube over one part of the revision, which is stored first."""
    return density.dense_density(genes(spark, d), _stored_revision(spark, d, part), windows, directions, kinds)


def _stranded(spark, d, directions=(LEFT, INTRA, RIGHT), windows=WINDOWS, part="all", kinds=BOTH) -> DataFrame:
    return density.stranded(_cube(spark, d, directions, windows, part, kinds))


# ---- sources and cleaning -----------------------------------------------------------------------------------------


@query_of(sql("SELECT * FROM genes", "genes"))
def gene_scan_clean(spark, d):
    raw = raw_genes(spark, d)
    text = raw.select(*(F.col(c).cast("double").cast("decimal(20,1)").cast("string").alias(n) if c in ("start", "stop", "length") else F.col(c).alias(n) for c, n in zip(("gene_name", "chrom", "feature", "start", "stop", "strand", "length"), ("Gene_Name", "Chromosome", "Feature", "Start", "Stop", "Strand", "Length"), strict=True)))
    return annotations.clean_genes(text)


@query_of(sql("SELECT * FROM tes", "tes"))
def te_scan_clean(spark, d):
    raw = tes(spark, d)
    text = raw.select(*(F.col(c).cast("string").alias(n) for c, n in zip(("chrom", "start", "stop", "strand", "te_order", "superfamily", "length"), ("Chromosome", "Start", "Stop", "Strand", "Order", "SuperFamily", "Length"), strict=True)))
    return annotations.clean_tes(text)


def _gff_lines(spark, d) -> DataFrame:
    return table(spark, d, "part").selectExpr(
        """concat(CASE WHEN p_partkey % 50 = 0 THEN '##sequence-region ' ELSE '' END, 'Chr', p_partkey % 5, '\t', CASE WHEN p_partkey % 3 = 0 THEN '\t' ELSE '' END,
        'sim\t', CASE WHEN p_size % 3 = 0 THEN 'mRNA' ELSE 'gene' END, '\t', (p_partkey * 4999) % 10000000 + 1, '.0\t', (p_partkey * 4999) % 10000000 + 100 + p_size * 20, '\t.\t',
        CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END, '\t.\t', CASE WHEN p_size % 11 = 0 THEN 'Name=x' ELSE concat('ID=gene_', p_partkey, ';Name=x') END, CASE WHEN p_partkey % 10 = 1 THEN '#note;' ELSE '' END) AS value"""
    )


@query_of("""SELECT 'Chr' || (p_partkey % 5) AS chrom, 'gene_' || p_partkey AS gene_name, 'gene' AS feature, CAST((p_partkey * 4999) % 10000000 + 1 AS BIGINT) AS start,
  CAST((p_partkey * 4999) % 10000000 + 100 + p_size * 20 AS BIGINT) AS stop, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(100 + p_size * 20 AS BIGINT) AS length
FROM part WHERE p_partkey % 50 <> 0 AND p_size % 3 <> 0 AND p_size % 11 <> 0""")
def gff_gene_import(spark, d):
    return annotations.gff_genes(_gff_lines(spark, d))


#: Classifications that the lines of the virtual annotation carry in turn.
CLASSES = ("LTR/Copia", "LTR/RLG", "DNA/DTA", "MITE/DTM", "DNA/Helitron", "Helitron/unknown", "LINE/unknown", "LINE/RIL", "Unknown", "pararetrovirus/x", "TIR/PIF_Harbinger", "LTR/unknown", "DNA/unknown", "")
_CLASS_ARRAY = "array(" + ", ".join(f"'{c}'" for c in CLASSES) + ")"
_CLASS_LIST = "[" + ", ".join(f"'{c}'" for c in CLASSES) + "]"
_NTH = "(l_orderkey + l_linenumber) % 14"


def _edta_lines(spark, d) -> DataFrame:
    at = "(l_orderkey * 7919 + l_linenumber * 104729) % 10000000"
    return table(spark, d, "lineitem").selectExpr(
        f"concat('Chr', l_suppkey % 5, '\tEDTA\trepeat\t', {at} + 1, '\t', {at} + CAST(floor(l_quantity) AS BIGINT) * 10, '\t.\t+\t.\tID=x;', "
        f"CASE WHEN {_NTH} = 13 THEN '' ELSE concat('Classification=', element_at({_CLASS_ARRAY}, CAST({_NTH} AS INT) + 1), ';') END, 'Method=m') AS value"
    )


_EDTA = f"""edta AS (
  SELECT chrom, p + 1 AS start, p + q AS stop, '+' AS strand, q AS length,
    CASE WHEN k = 13 THEN 'nan' ELSE split_part(c, '/', 1) END AS te_order, CASE WHEN k = 13 THEN 'nan' WHEN contains(c, '/') THEN split_part(c, '/', 2) ELSE 'None' END AS superfamily
  FROM (SELECT 'Chr' || (l_suppkey % 5) AS chrom, CAST((l_orderkey * 7919 + l_linenumber * 104729) % 10000000 AS BIGINT) AS p, CAST(floor(l_quantity) AS BIGINT) * 10 AS q,
    {_NTH} AS k, {_CLASS_LIST}[{_NTH} + 1] AS c FROM lineitem)
)"""


@query_of(sql("SELECT * FROM edta", _EDTA))
def edta_te_import(spark, d):
    return annotations.gff_tes(_edta_lines(spark, d))


def _map_sql(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {column} END"


@query_of(
    sql(
        "SELECT chrom, start, stop, strand, length, CASE WHEN o = 'Unknown_Order' AND f = 'Unknown_Superfam' THEN 'Completely_Unknown' ELSE o END AS te_order, "
        "CASE WHEN o = 'Unknown_Order' AND f = 'Unknown_Superfam' THEN 'Completely_Unknown' ELSE f END AS superfamily FROM ("
        "SELECT *, CASE WHEN te_order = 'TIR' AND superfamily = 'Helitron' THEN 'Helitron' ELSE te_order END AS o, "
        "CASE WHEN te_order = 'Helitron' AND superfamily = 'Unknown_Superfam' THEN 'Helitron' ELSE superfamily END AS f FROM ("
        "SELECT chrom, start, stop, strand, length, te_order, CASE WHEN te_order = 'pararetrovirus' THEN 'pararetrovirus' "
        "WHEN te_order IN ('LINE', 'LTR', 'TIR') AND superfamily = 'Unknown_Superfam' THEN 'Unknown_' || te_order || '_Superfam' ELSE superfamily END AS superfamily FROM ("
        f"SELECT * REPLACE ({_map_sql('te_order', names.EDTA_ORDERS)} AS te_order, {_map_sql('superfamily', names.EDTA_SUPERFAMILIES)} AS superfamily) FROM edta)))",
        _EDTA,
    )
)
def te_rename(spark, d):
    return annotations.gff_tes(_edta_lines(spark, d), names.rename_edta)


_ODD_ORDERS = ("LTR", "DNA", "MITE", "RC", "SINE?", "tandem", "mixture", "Unknown", "Helitron", "pararetrovirus", "Simple_repeat", "Maverick", "LINE")
_ODD_FAMILIES = ("Copia", "DTA", "unknown", "DHH", "Gypsy", "Uknown", "EnSpm_CACTA")
_HUMAN_ORDERS = ("LINE", "SINE", "LTR", "DNA", "tRNA", "RC", "Satellite", "LTR?", "DNA?", "snRNA", "Low_complexity")
_HUMAN_FAMILIES = ("Penelope", "L1", "ERV1", "ERVL", "ERVL-MaLR", "DNA", "hAT?", "Alu", "Gypsy", "hAT-Charlie", "TcMar?", "MIR")


def _labelled(spark, d, orders, families) -> DataFrame:
    pick = lambda values, by: f"element_at(array({', '.join(repr(v) for v in values)}), CAST({by} % {len(values)} AS INT) + 1)"
    return table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CASE WHEN l_orderkey % 13 = 0 THEN concat('contig', l_suppkey) ELSE concat('chr', l_suppkey % 15) END AS chrom",
        f"{pick(orders, 'l_orderkey')} AS te_order", f"CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE {pick(families, 'l_partkey')} END AS superfamily",
    )


def _labelled_sql(orders, families) -> str:
    pick = lambda values, by: f"[{', '.join(repr(v) for v in values)}][{by} % {len(values)} + 1]"
    return f"""labelled AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 13 = 0 THEN 'contig' || l_suppkey ELSE 'chr' || (l_suppkey % 15) END AS chrom,
    {pick(orders, "l_orderkey")} AS te_order, CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE {pick(families, "l_partkey")} END AS superfamily FROM lineitem
)"""


@query_of(
    sql(
        "SELECT l_orderkey, l_linenumber, chrom, te_order, CASE WHEN te_order = 'Mixture' THEN 'Mixture' WHEN te_order = 'LTR' AND superfamily NOT IN ('Copia', 'Gypsy') THEN 'Unknown_LTR_Superfam' ELSE superfamily END AS superfamily FROM ("
        "SELECT * REPLACE (CASE WHEN superfamily = 'Helitron' THEN 'Helitron' ELSE te_order END AS te_order) FROM ("
        "SELECT * REPLACE (CASE WHEN te_order = 'Helitron' AND superfamily = 'Unknown_SuperFam' THEN 'Helitron' ELSE superfamily END AS superfamily) FROM ("
        "SELECT * REPLACE (CASE WHEN u THEN 'Completely_Unknown' ELSE te_order END AS te_order, CASE WHEN u THEN 'Completely_Unknown' ELSE superfamily END AS superfamily) FROM ("
        "SELECT *, te_order = 'Unknown_Order' AND superfamily = 'Unknown_SuperFam' AS u FROM ("
        "SELECT * REPLACE (CASE WHEN te_order = 'Tandem' THEN 'Tandem' ELSE superfamily END AS superfamily) FROM ("
        f"SELECT l_orderkey, l_linenumber, chrom, {_map_sql('te_order', names.LEGACY_ORDERS)} AS te_order, {_map_sql('coalesce(superfamily, \'Unknown_SuperFam\')', names.LEGACY_SUPERFAMILIES)} AS superfamily FROM labelled "
        "WHERE NOT contains(chrom, 'contig'))))))) WHERE te_order NOT IN ('Simple_repeat', 'long_terminal_repeat', 'Maverick', 'target_site_duplication')",
        _labelled_sql(_ODD_ORDERS, _ODD_FAMILIES),
    )
)
def te_rename_legacy(spark, d):
    return names.rename_legacy(_labelled(spark, d, _ODD_ORDERS, _ODD_FAMILIES))


@query_of(
    sql(
        "SELECT l_orderkey, l_linenumber, chrom, CASE WHEN o = 'DNA' THEN 'TIR' ELSE o END AS te_order, superfamily FROM (SELECT *, CASE WHEN te_order = 'LINE' AND superfamily = 'Penelope' THEN 'PLE' ELSE te_order END AS o FROM labelled) "
        f"WHERE o NOT IN ({', '.join(map(repr, names.HUMAN_DROPPED_ORDERS))}) AND coalesce(superfamily, '') NOT IN ({', '.join(map(repr, names.HUMAN_DROPPED_SUPERFAMILIES))})",
        _labelled_sql(_HUMAN_ORDERS, _HUMAN_FAMILIES),
    )
)
def te_rename_human(spark, d):
    return names.rename_human(_labelled(spark, d, _HUMAN_ORDERS, _HUMAN_FAMILIES))


@query_of("""SELECT 'chr' || (l_suppkey % 24) AS chrom, CAST(l_orderkey * 100 AS BIGINT) AS start, CAST(l_orderkey * 100 + l_partkey AS BIGINT) AS stop, '+' AS strand, 'SINE' AS te_order, 'Alu' AS superfamily, CAST(l_partkey + 1 AS BIGINT) AS length
FROM lineitem WHERE l_suppkey % 24 IN (7, 13)""")
def repeatmasker_import(spark, d):
    raw = table(spark, d, "lineitem").selectExpr("concat('chr', l_suppkey % 24) AS genoName", "CAST(l_orderkey * 100 AS STRING) AS genoStart", "CAST(l_orderkey * 100 + l_partkey AS STRING) AS genoEnd", "'+' AS strand", "'SINE' AS repClass", "'Alu' AS repFamily", "1 AS swScore")
    return annotations.repeat_table(raw, ["chr7", "chr13"])


@query_of("""SELECT CAST(p_partkey % 14 AS VARCHAR) AS chrom, 'g' || p_partkey AS gene_a, 'Os' || p_partkey || 'g5' AS gene_b, p_size / 500.0 AS e_value FROM part
WHERE p_size < 25 AND p_partkey % 14 BETWEEN 1 AND 12 AND p_partkey % 9 <> 0 AND p_partkey % 6 <> 0""")
def syntelog_import(spark, d):
    lines = table(spark, d, "part").selectExpr(
        """concat('a1_', p_partkey % 14, '\tx||1||2||', CASE WHEN p_partkey % 9 = 0 THEN 'transcript:' ELSE 'CDS:' END, 'g', p_partkey, '.1||z\t1\t2\tb2_', CASE WHEN p_partkey % 6 = 0 THEN 99 ELSE p_partkey % 14 END,
        '\ty||1||2||CDS:Os', p_partkey, 't5-01||z\t3\t4\t', p_size / 500.0D, '\t50') AS value"""
    )
    return annotations.gene_pairs(lines)


@query_of("SELECT CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN p_name ELSE concat(p_name, p_partkey) END AS gene_name, p_partkey FROM part QUALIFY count(*) OVER (PARTITION BY gene_name) = 1")
def drop_all_duplicates(spark, d):
    return checks.drop_all_duplicates(table(spark, d, "part").selectExpr("CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN p_name ELSE concat(p_name, p_partkey) END AS gene_name", "p_partkey"))


@query_of(sql("SELECT gene_name, CASE WHEN length % 300 = 0 THEN NULL WHEN length % 500 = 0 THEN '?' ELSE strand END AS strand FROM raw_genes WHERE length % 300 = 0 OR length % 500 = 0", "genes"))
def strand_check(spark, d):
    odd = raw_genes(spark, d).selectExpr("gene_name", "CASE WHEN length % 300 = 0 THEN NULL WHEN length % 500 = 0 THEN '?' ELSE strand END AS strand")
    return checks.bad_strands(odd)


@query_of("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS a, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS b FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0")
def null_rows(spark, d):
    return checks.rows_with_nulls(table(spark, d, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS a", "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS b"))


@query_of("SELECT CAST(count(*) FILTER (WHERE o_orderkey % 7 = 0) AS BIGINT) AS a, CAST(count(*) FILTER (WHERE o_orderkey % 11 = 0) AS BIGINT) AS b FROM orders")
def null_column_counts(spark, d):
    return checks.null_counts(table(spark, d, "orders").selectExpr("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS a", "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS b"))


@query_of("""SELECT chrom, 'genes' AS only_in FROM (SELECT DISTINCT 'Chr' || (p_partkey % 9) AS chrom FROM part EXCEPT SELECT DISTINCT 'Chr' || (3 * (l_suppkey % 5)) FROM lineitem)
UNION ALL SELECT chrom, 'tes' FROM (SELECT DISTINCT 'Chr' || (3 * (l_suppkey % 5)) AS chrom FROM lineitem EXCEPT SELECT DISTINCT 'Chr' || (p_partkey % 9) FROM part)""")
def chrom_set_diff(spark, d):
    a = table(spark, d, "part").selectExpr("concat('Chr', p_partkey % 9) AS chrom")
    return checks.chromosome_difference(a, table(spark, d, "lineitem").selectExpr("concat('Chr', 3 * (l_suppkey % 5)) AS chrom"))


# ---- revision -----------------------------------------------------------------------------------------------------


@query_of(sql("SELECT * FROM revised WHERE te_order = 'S_Revision'", "revised"))
def interval_union_superfamily(spark, d):
    return interval_union(superfamily_rows(tes(spark, d)), _KEYS)


@query_of(sql("SELECT * FROM revised WHERE superfamily = 'O_Revision'", "revised"))
def interval_union_order(spark, d):
    return interval_union(order_rows(tes(spark, d)), _KEYS)


@query_of(sql(f"SELECT * FROM revised WHERE te_order = '{TOTAL}'", "revised"))
def interval_union_total(spark, d):
    return interval_union(total_rows(tes(spark, d)), _KEYS)


@query_of(sql("SELECT * FROM revised", "revised"))
def revised_annotation(spark, d):
    return _revised(spark, d)


# ---- windows, overlaps, density -----------------------------------------------------------------------------------


@query_of(sql('SELECT gene_name, chrom, direction, "window", r_start, r_stop, divisor FROM regions', "regions"))
def window_regions(spark, d):
    return regions(genes(spark, d), WINDOWS).select("gene_name", "chrom", "direction", "window", "r_start", "r_stop", "divisor")


def _overlap_sql(direction: str) -> str:
    return sql(
        f"""SELECT r.gene_name, r."window", CAST(count(*) AS BIGINT) AS n, CAST(sum(least(r.r_stop, t.stop) - greatest(r.r_start, t.start) + 1) AS BIGINT) AS bp
FROM regions r JOIN tes t ON r.chrom = t.chrom AND t.start <= r.r_stop AND t.stop >= r.r_start WHERE r.direction = '{direction}' GROUP BY ALL""",
        "regions", "tes",
    )


def _overlap(spark, d, direction: str) -> DataFrame:
    return density.overlap_counts(genes(spark, d), tes(spark, d), WINDOWS, direction).select("gene_name", "window", "n", "bp")


@query_of(_overlap_sql(LEFT))
def overlap_left(spark, d):
    return _overlap(spark, d, LEFT)


@query_of(_overlap_sql(INTRA))
def overlap_intra(spark, d):
    return _overlap(spark, d, INTRA)


@query_of(_overlap_sql(RIGHT))
def overlap_right(spark, d):
    return _overlap(spark, d, RIGHT)


_CELL = 'chrom, gene_name, direction, "window", te_name, overlap_bp, density'
_CELLS = ["chrom", "gene_name", "direction", "window", "te_name", "overlap_bp", "density"]


@query_of(sql(f"SELECT {_CELL} FROM cube WHERE te_category = 'Order'", "cube"))
def density_order(spark, d):
    return _cube(spark, d, kinds=(ORDER,)).select(_CELLS)


@query_of(sql(f"SELECT {_CELL} FROM cube WHERE te_category = 'Superfamily'", "cube"))
def density_superfamily(spark, d):
    return _cube(spark, d, kinds=(SUPERFAMILY,)).select(_CELLS)


@query_of(sql(f"SELECT {_CELL} FROM cube WHERE te_category = 'Order' AND te_name = '{TOTAL}'", "cube"))
def density_total(spark, d):
    return _cube(spark, d, part="total", kinds=(ORDER,)).select(_CELLS)


@query_of(sql('SELECT chrom, gene_name, direction, "window", te_category, te_name, overlap_bp, divisor, density FROM cube WHERE overlap_bp > 0', "cube"))
def density_sparse(spark, d):
    return density.sparse_density(genes(spark, d), _stored_revision(spark, d), WINDOWS).select("chrom", "gene_name", "direction", "window", "te_category", "te_name", "overlap_bp", "divisor", "density")


@query_of(sql('SELECT chrom, gene_name, direction, "window", te_category, te_name, density FROM stranded', "cube"))
def stranded_density(spark, d):
    return _stranded(spark, d).select("chrom", "gene_name", "direction", "window", "te_category", "te_name", "density")


@query_of(sql("SELECT chrom, gene_name, density FROM stranded WHERE te_category = 'Order' AND te_name = 'LTR' AND direction = 'Upstream' AND \"window\" = 1000", "cube"))
def density_slice(spark, d):
    revised = _stored_revision(spark, d, "orders")
    cube = density.stranded(density.dense_density(genes(spark, d), revised, (1000,), (LEFT, RIGHT), (ORDER,)))
    names = density.names_by_chromosome(revised, (ORDER,))
    return query.density_slice(cube, ORDER, "LTR", "Upstream", 1000, WINDOWS, names).select("chrom", "gene_name", "density")


@query_of(sql("SELECT *, CAST(row_number() OVER (PARTITION BY chrom ORDER BY start, gene_name) - 1 AS BIGINT) AS gene_index FROM genes", "genes"))
def gene_index(spark, d):
    return query.gene_index(genes(spark, d))


@query_of(
    sql(
        """SELECT g.chrom, g.gene_name, coalesce(max(density) FILTER (WHERE te_name = 'LTR' AND direction = 'Upstream' AND "window" = 500), 0) AS "LTR_500_Upstream",
  coalesce(max(density) FILTER (WHERE te_name = 'TIR' AND direction = 'Downstream' AND "window" = 5000), 0) AS "TIR_5000_Downstream",
  coalesce(max(density) FILTER (WHERE te_name = 'Helitron' AND direction = 'Intra'), 0) AS "Helitron_Intra",
  coalesce(max(density) FILTER (WHERE te_name = 'Absent' AND direction = 'Intra'), 0) AS "Absent_Intra"
FROM genes g LEFT JOIN stranded s ON s.chrom = g.chrom AND s.gene_name = g.gene_name AND te_category = 'Order' GROUP BY g.chrom, g.gene_name""",
        "cube",
    )
)
def gene_te_columns(spark, d):
    wanted = [(ORDER, "LTR", "Upstream", 500), (ORDER, "TIR", "Downstream", 5000), (ORDER, "Helitron", "Intra", None), (ORDER, "Absent", "Intra", None)]
    revised = _stored_revision(spark, d, "orders")
    cube = density.stranded(density.dense_density(genes(spark, d), revised, (500, 5000), kinds=(ORDER,)))
    return query.append_columns(genes(spark, d).select("chrom", "gene_name"), cube, wanted, density.names_by_chromosome(revised, (ORDER,)))


@query_of(
    sql(
        """SELECT chrom, te_category, te_name, direction, "window", CAST(count(*) AS BIGINT) AS genes, CAST(sum(overlap_bp) AS BIGINT) AS bp FROM stranded
WHERE direction <> 'Intra' AND NOT contains(te_name, 'Revision') GROUP BY ALL""",
        "cube",
    )
)
def all_slices(spark, d):
    rows = query.all_slices(_stranded(spark, d, (LEFT, RIGHT)))
    return rows.groupBy("chrom", "te_category", "te_name", "direction", "window").agg(F.count("*").alias("genes"), F.sum("overlap_bp").alias("bp"))


@query_of(
    sql(
        """SELECT gene_name, te_category, direction, te_name, density, place, "end" FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY chrom, gene_name, te_category, direction ORDER BY density DESC, te_name) AS INTEGER) AS place, 'top' AS "end" FROM stranded WHERE direction = 'Intra' OR "window" = 1000
  UNION ALL
  SELECT *, CAST(row_number() OVER (PARTITION BY chrom, gene_name, te_category, direction ORDER BY density, te_name) AS INTEGER), 'bottom' FROM stranded WHERE direction = 'Intra' OR "window" = 1000
) WHERE place <= 5""",
        "cube",
    )
)
def gene_top_bottom(spark, d):
    return query.top_bottom(_stranded(spark, d, windows=(1000,)), 1000).select("gene_name", "te_category", "direction", "te_name", "density", "place", "end")


@query_of(sql("""SELECT te_category, te_name, direction, "window", round(avg(density), 6) AS mean_density FROM stranded WHERE NOT contains(te_name, 'Revision') GROUP BY ALL""", "cube"))
def mean_density_by_window(spark, d):
    rows = density.mean_densities(genes(spark, d), _stored_revision(spark, d), WINDOWS)
    return density.without_revisions(rows).withColumn("mean_density", F.round("mean_density", 6))


_UPDOWN = """means AS (
  SELECT chrom, te_name, avg(density) FILTER (WHERE direction = 'Upstream') AS up, avg(density) FILTER (WHERE direction = 'Downstream') AS down
  FROM stranded WHERE te_category = 'Order' AND "window" = 1000 AND NOT contains(te_name, 'Revision') GROUP BY chrom, te_name
)"""


@query_of(sql("SELECT chrom, te_name, round(up, 6) AS up, round(down, 6) AS down, round((up + down) / 2, 6) AS mid, round(chi, 6) AS chi_square, round(1 - exp(-chi / 2) * sqrt(chi / 2) * list_sum(list_transform(range(60), lambda k: pow(chi / 2, k) / gamma(k + 1.5))), 6) AS p_value FROM (SELECT *, (up - (up + down) / 2) ** 2 / ((up + down) / 2) + (down - (up + down) / 2) ** 2 / ((up + down) / 2) AS chi FROM means)", "cube", _UPDOWN))
def updown_midpoint_chisq(spark, d):
    cube = density.without_revisions(_stranded(spark, d, (LEFT, RIGHT), (1000,), kinds=(ORDER,)))
    side = lambda x: F.avg(F.when(F.col("direction") == x, F.col("density")))
    m = cube.groupBy("chrom", "te_name").agg(side("Upstream").alias("up"), side("Downstream").alias("down")).withColumn("mid", (F.col("up") + F.col("down")) / 2)
    chi = stats.chi_square([F.col("up"), F.col("down")], F.nullif(F.col("mid"), F.lit(0.0)))
    return m.select("chrom", "te_name", F.round("up", 6).alias("up"), F.round("down", 6).alias("down"), F.round("mid", 6).alias("mid"), F.round(chi, 6).alias("chi_square"), F.round(stats.chi_square_p(chi), 6).alias("p_value"))


def _bin_sql(value: str) -> str:
    cases = [f"WHEN {value} >= 0 AND {value} <= 0.1::DOUBLE THEN '{stats.bin_label(0)}'"]
    cases += [f"WHEN {value} > {stats.EDGES[k]!r}::DOUBLE AND {value} <= {stats.EDGES[k + 1]!r}::DOUBLE THEN '{stats.bin_label(k)}'" for k in range(1, 10)]
    return "CASE " + " ".join(cases) + " END"


_LABELS = "labels10(bin) AS (VALUES " + ", ".join(f"('{stats.bin_label(k)}')" for k in range(10)) + ")"


@query_of(
    sql(
        f"""SELECT f.te_name, f.bin, CAST(count(c.bin) AS BIGINT) AS n FROM (SELECT DISTINCT te_name, bin FROM slice, labels10) f
LEFT JOIN (SELECT te_name, {_bin_sql("density")} AS bin FROM slice) c ON c.te_name = f.te_name AND c.bin = f.bin GROUP BY ALL""",
        "cube", """slice AS (SELECT te_name, density FROM stranded WHERE te_category = 'Order' AND direction = 'Upstream' AND "window" = 1000 AND NOT contains(te_name, 'Revision'))""", _LABELS,
    )
)
def density_bins(spark, d):
    cube = density.without_revisions(_stranded(spark, d, (LEFT, RIGHT), (1000,), kinds=(ORDER,))).where(F.col("direction") == "Upstream")
    return stats.count_bins(cube.select("te_name", "density"), F.col("density"), ("te_name",))


@query_of(sql("SELECT te_name, round(avg(CASE WHEN density >= 0.5 THEN 1.0 ELSE 0.0 END), 9) AS share FROM stranded WHERE te_category = 'Order' AND direction = 'Upstream' AND \"window\" = 1000 GROUP BY te_name", "cube"))
def share_over_half(spark, d):
    cube = _stranded(spark, d, (LEFT, RIGHT), (1000,), kinds=(ORDER,)).where(F.col("direction") == "Upstream")
    return stats.share_at_least(cube, "density", 0.5, ("te_name",)).withColumn("share", F.round("share", 9))


_TOTAL_UP = f"""total_up AS (SELECT gene_name, density FROM stranded WHERE te_category = 'Order' AND te_name = '{TOTAL}' AND direction = 'Upstream' AND "window" = 5000)"""


def _total_up(spark, d) -> DataFrame:
    cube = _stranded(spark, d, (LEFT, RIGHT), (5000,), "total", (ORDER,))
    return cube.where(F.col("direction") == "Upstream").select("gene_name", "density")


@query_of(sql("SELECT gene_name, density FROM total_up WHERE density >= (SELECT quantile_cont(density, 0.99) FROM total_up)", "cube", _TOTAL_UP))
def outlier_genes_p99(spark, d):
    return query.outliers(stored(_total_up(spark, d), "densities"), "density").select("gene_name", "density")


@query_of(
    sql(
        """SELECT gene_name, density FROM (SELECT *, row_number() OVER (ORDER BY md5(gene_name), gene_name) AS r FROM total_up WHERE density >= (SELECT quantile_cont(density, 0.01) FROM total_up)
  AND density < (SELECT quantile_cont(density, 0.99) FROM total_up)) WHERE r <= (SELECT count(*) FROM total_up WHERE density >= (SELECT quantile_cont(density, 0.99) FROM total_up))""",
        "cube", _TOTAL_UP,
    )
)
def outlier_counterparts(spark, d):
    """As many ordinary genes as there are outliers, drawn in hash order: the sample is the operator."""
    cube = stored(_total_up(spark, d), "densities")
    low, high = quantiles.exact_quantiles(cube, "density", [0.01, 0.99])
    n = cube.where(F.col("density") >= high).count()
    ordinary = cube.where((F.col("density") >= low) & (F.col("density") < high))
    return quantiles.hash_sample(ordinary, n, "gene_name").select("gene_name", "density")


_DIFF = """pairs AS (
  SELECT 'gene_' || p_partkey AS gene_a, 'gene_' || (p_partkey + 5) AS gene_b FROM part WHERE p_partkey % 2 = 1
), compared AS MATERIALIZED (
  SELECT gene_name, te_category, te_name, direction, "window", density FROM stranded
  WHERE te_category = 'Order' AND direction <> 'Intra' AND "window" IN (1000, 5000) AND NOT contains(te_name, 'Revision')
), diffs AS (
  SELECT gene_a, gene_b, a.te_category, a.te_name, a.direction, a."window", a.density - b.density AS difference
  FROM pairs JOIN compared a ON a.gene_name = gene_a JOIN compared b ON b.gene_name = gene_b AND a.te_name = b.te_name AND a.direction = b.direction AND a."window" = b."window"
)"""


def _differences(spark, d) -> DataFrame:
    pairs = table(spark, d, "part").where("p_partkey % 2 = 1").selectExpr("concat('gene_', p_partkey) AS gene_a", "concat('gene_', p_partkey + 5) AS gene_b")
    cube = density.without_revisions(_stranded(spark, d, (LEFT, RIGHT), (1000, 5000), kinds=(ORDER,)))
    return query.differences_within(pairs, cube)


@query_of(sql("SELECT * FROM diffs", "cube", _DIFF))
def syntelog_diff(spark, d):
    return _differences(spark, d)


@query_of(
    sql(
        """SELECT te_name, direction, "window", CASE WHEN difference = 1 THEN 19 ELSE least(19, CAST(floor((difference + 1) / (2.0::DOUBLE / 20)) AS INTEGER)) END AS bin,
  CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE difference = 0) AS BIGINT) AS zeros FROM diffs WHERE difference BETWEEN -1 AND 1 GROUP BY ALL""",
        "cube", _DIFF,
    )
)
def syntelog_diff_hist(spark, d):
    rows = _differences(spark, d).withColumn("bin", stats.histogram_bin(F.col("difference"))).where("bin IS NOT NULL")
    return rows.groupBy("te_name", "direction", "window", "bin").agg(F.count("*").alias("n"), F.count_if(F.col("difference") == 0).alias("zeros"))


BOUNDARIES = [("Chr0", 1_000_000, 3_000_000), ("Chr1", 2_000_000, 2_500_000), ("Chr2", 9_000_000, 9_990_000), ("Chr3", 1, 500_000)]
_BOUNDS = "bounds(chrom, b_start, b_stop) AS (VALUES " + ", ".join(f"('{c}', {a}, {b})" for c, a, b in BOUNDARIES) + ")"
_FLAGGED = """flagged_genes AS (SELECT g.*, CASE WHEN EXISTS (SELECT 1 FROM bounds b WHERE b.chrom = g.chrom AND g.start >= b_start AND g.stop <= b_stop) THEN 'Y' ELSE 'N' END AS within_boundary FROM genes g)"""


def _flagged(spark, d) -> DataFrame:
    return query.inside_boundaries(genes(spark, d), spark.createDataFrame(BOUNDARIES, "chrom string, b_start long, b_stop long"))


@query_of(sql("SELECT * FROM flagged_genes", "genes", _BOUNDS, _FLAGGED))
def centromere_flag(spark, d):
    return _flagged(spark, d)


_EXPRESSION = """expression AS (SELECT 'gene_' || o_custkey AS gene_name, avg(o_totalprice) / 1e5 AS tpm, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS cents, count(*) AS n FROM orders GROUP BY o_custkey)"""


def _expression(spark, d) -> DataFrame:
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
    return table(spark, d, "orders").groupBy(F.concat(F.lit("gene_"), "o_custkey").alias("gene_name")).agg(cents.cast("double").alias("cents"), F.count("*").alias("n"))


def _expression_sql(test: str) -> str:
    return sql(
        f"""SELECT bin, CAST(count(*) AS BIGINT) AS n, round(avg(log10(cents / n / 1e7 + 1)), 6) AS mean_log FROM (
  SELECT {_bin_sql("density")} AS bin, cents, n FROM total_up JOIN expression USING (gene_name) WHERE cents / n / 1e7 {test}) WHERE bin IS NOT NULL GROUP BY bin""",
        "cube", _TOTAL_UP, _EXPRESSION,
    )


_TPM = "cents / n / 1e7D"


def _expression_by_bin(spark, d, wanted) -> DataFrame:
    joined = _total_up(spark, d).join(_expression(spark, d), "gene_name").where(f"{_TPM} {wanted}").withColumn("bin", stats.density_bin(F.col("density")))
    return joined.where("bin IS NOT NULL").groupBy("bin").agg(F.count("*").alias("n"), F.round(F.avg(F.log10(F.expr(_TPM) + 1)), 6).alias("mean_log"))


@query_of(_expression_sql(">= 0.1"))
def expression_by_density_bin(spark, d):
    return _expression_by_bin(spark, d, ">= 0.1D")


@query_of(_expression_sql("< 1.3"))
def low_expression_by_density_bin(spark, d):
    """Genes below a threshold of expression (1.3 here, as none of the test tables' genes lies near 0)."""
    return _expression_by_bin(spark, d, "< 1.3D")


@query_of(
    sql(
        """SELECT within_boundary, CAST(count(*) AS BIGINT) AS genes, round(avg(CASE WHEN density >= 0.5 THEN 1.0 ELSE 0.0 END), 9) AS share, round(avg(log10(cents / n / 1e7 + 1)), 6) AS mean_log
FROM flagged_genes JOIN total_up USING (gene_name) JOIN expression USING (gene_name) GROUP BY within_boundary""",
        "cube", _TOTAL_UP, _BOUNDS, _FLAGGED, _EXPRESSION,
    )
)
def centromere_expression(spark, d):
    rows = _flagged(spark, d).select("gene_name", "within_boundary").join(_total_up(spark, d), "gene_name").join(_expression(spark, d), "gene_name")
    share = F.round(F.avg(F.when(F.col("density") >= 0.5, 1.0).otherwise(0.0)), 9)
    return rows.groupBy("within_boundary").agg(F.count("*").alias("genes"), share.alias("share"), F.round(F.avg(F.log10(F.expr(_TPM) + 1)), 6).alias("mean_log"))


@query_of(
    sql(
        """SELECT g.gene_name, g.chrom, s.density FROM (SELECT DISTINCT 'gene_' || o_custkey AS gene_name FROM orders) k JOIN genes g USING (gene_name)
LEFT JOIN (SELECT gene_name, density FROM total_up WHERE density > 0.2) s USING (gene_name)""",
        "cube", _TOTAL_UP,
    )
)
def reindexed_density(spark, d):
    keys = table(spark, d, "orders").selectExpr("concat('gene_', o_custkey) AS gene_name").distinct().join(genes(spark, d).select("gene_name", "chrom"), "gene_name")
    return query.reindex(_total_up(spark, d).where("density > 0.2"), keys)


@query_of(sql(f"SELECT within_boundary, bin, CAST(count(*) AS BIGINT) AS n FROM (SELECT within_boundary, {_bin_sql('density')} AS bin FROM flagged_genes JOIN total_up USING (gene_name)) WHERE bin IS NOT NULL GROUP BY ALL", "cube", _TOTAL_UP, _BOUNDS, _FLAGGED))
def centromere_density_bins(spark, d):
    cube = _total_up(spark, d)
    joined = _flagged(spark, d).select("gene_name", "within_boundary").join(cube.select("gene_name", "density"), "gene_name")
    return joined.withColumn("bin", stats.density_bin(F.col("density"))).where("bin IS NOT NULL").groupBy("within_boundary", "bin").agg(F.count("*").alias("n"))


@query_of(sql("""SELECT chrom, gene_name, max(density) FILTER (WHERE direction = 'Upstream') AS upstream, max(density) FILTER (WHERE direction = 'Downstream') AS downstream FROM stranded WHERE te_category = 'Order' AND te_name = 'TIR' AND "window" = 1000 GROUP BY ALL""", "cube"))
def paired_columns(spark, d):
    return sinks.paired_columns(_stranded(spark, d, (LEFT, RIGHT), (1000,), "orders", (ORDER,)), ORDER, "TIR", 1000)


# ---- descriptive statistics ---------------------------------------------------------------------------------------


@query_of(sql("SELECT te_order, CAST(count(*) AS BIGINT) AS n FROM tes GROUP BY te_order", "tes"))
def te_counts_by_order(spark, d):
    return stats.lengths_by(tes(spark, d), "te_order").select("te_order", "n")


@query_of(sql("SELECT superfamily, CAST(sum(length) AS BIGINT) AS total FROM tes GROUP BY superfamily", "tes"))
def te_length_sums(spark, d):
    return stats.lengths_by(tes(spark, d), "superfamily").select("superfamily", "total")


@query_of(sql("SELECT te_order, round(avg(length), 6) AS mean FROM tes GROUP BY te_order", "tes"))
def te_length_mean(spark, d):
    return stats.lengths_by(tes(spark, d), "te_order").select("te_order", F.round("mean", 6).alias("mean"))


@query_of(sql("SELECT superfamily, median(length) AS median FROM tes GROUP BY superfamily", "tes"))
def te_length_median(spark, d):
    return quantiles.grouped_medians(tes(spark, d), "superfamily", "length")


@query_of(sql("SELECT (SELECT CAST(count(*) AS BIGINT) FROM genes) AS n_genes, (SELECT CAST(sum(length) AS BIGINT) FROM genes) AS gene_bp, CAST(count(*) AS BIGINT) AS n_tes, CAST(sum(length) AS BIGINT) AS te_bp, CAST(sum(length) AS DOUBLE) / 119e6 AS te_share FROM tes", "genes", "tes"))
def genome_totals(spark, d):
    g = genes(spark, d).agg(F.count("*").alias("n_genes"), F.sum("length").alias("gene_bp"))
    t = tes(spark, d).agg(F.count("*").alias("n_tes"), F.sum("length").alias("te_bp"))
    return g.crossJoin(t).withColumn("te_share", F.col("te_bp").cast("double") / F.lit(119e6))


@query_of(sql("SELECT CAST(sum(stop) AS DOUBLE) / 1e9 AS size_gb FROM (SELECT chrom, max(stop) AS stop FROM (SELECT chrom, stop FROM genes UNION ALL SELECT chrom, stop FROM tes) WHERE chrom IN ('Chr0', 'Chr2') GROUP BY chrom)", "genes", "tes"))
def subgenome_size(spark, d):
    return stats.genome_size(genes(spark, d), tes(spark, d), ["Chr0", "Chr2"])


@query_of(sql("SELECT CAST(count(DISTINCT chrom) AS BIGINT) AS chromosomes, CAST(count(DISTINCT te_order) AS BIGINT) AS orders, CAST(count(DISTINCT superfamily) AS BIGINT) AS superfamilies FROM tes", "tes"))
def te_cardinality(spark, d):
    return tes(spark, d).agg(F.count_distinct("chrom").alias("chromosomes"), F.count_distinct("te_order").alias("orders"), F.count_distinct("superfamily").alias("superfamilies"))


@query_of(sql("SELECT te_order, CAST(sum(length) AS DOUBLE) / (SELECT sum(length) FROM tes) AS share FROM tes GROUP BY te_order", "tes"))
def orders_as_fraction(spark, d):
    t = tes(spark, d)
    return t.groupBy("te_order").agg(F.sum("length").alias("bp")).crossJoin(F.broadcast(t.agg(F.sum("length").alias("all")))).select("te_order", (F.col("bp").cast("double") / F.col("all")).alias("share"))


@query_of(sql("SELECT chrom, 'Test' AS source, te_order || '/' || superfamily AS feature, start, stop AS \"end\", '.' AS score, strand, 1 AS phase, 'Test' AS attributes FROM tes", "tes"))
def gff_export_rows(spark, d):
    return sinks.gff_rows(tes(spark, d))


@query_of("""SELECT s_suppkey, CASE WHEN a IS NULL AND b IS NULL AND c IS NULL THEN NULL ELSE (coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / ((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT) END AS mean FROM (
  SELECT l_suppkey AS s_suppkey, max(l_quantity) FILTER (WHERE l_returnflag = 'A') AS a, max(l_quantity) FILTER (WHERE l_returnflag = 'N' AND l_partkey % 3 = 0) AS b, max(l_quantity) FILTER (WHERE l_returnflag = 'R' AND l_partkey % 50 = 0) AS c
  FROM lineitem GROUP BY l_suppkey)""")
def row_mean_expression(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.max(F.when(F.expr("l_returnflag = 'A'"), F.col("l_quantity"))).alias("a"),
        F.max(F.when(F.expr("l_returnflag = 'N' AND l_partkey % 3 = 0"), F.col("l_quantity"))).alias("b"),
        F.max(F.when(F.expr("l_returnflag = 'R' AND l_partkey % 50 = 0"), F.col("l_quantity"))).alias("c"),
    )
    return rows.select("s_suppkey", stats.row_mean(["a", "b", "c"]).alias("mean"))


@query_of("""SELECT 2 * p_partkey AS line, '>Auxiliary_' || row_number() OVER (ORDER BY p_partkey) AS value FROM part WHERE p_partkey % 4 <> 0
UNION ALL SELECT 2 * p_partkey, '>seq7' FROM part WHERE p_partkey % 4 = 0 UNION ALL SELECT 2 * p_partkey + 1, 'ACGT' || p_size FROM part""")
def fasta_rename(spark, d):
    part = table(spark, d, "part")
    heads = part.selectExpr("2 * p_partkey AS line", "CASE WHEN p_partkey % 4 = 0 THEN '>seq7 of the assembly' ELSE concat('>contig', p_partkey, ' x') END AS value")
    return annotations.rename_sequences(heads.unionByName(part.selectExpr("2 * p_partkey + 1 AS line", "concat('ACGT', p_size) AS value")), ["seq7"])


@query_of(sql("SELECT g.* FROM genes g SEMI JOIN (SELECT 'gene_' || (o_custkey * 3) AS gene_name FROM orders) o USING (gene_name)", "genes"))
def listed_genes(spark, d):
    wanted = table(spark, d, "orders").selectExpr("concat('gene_', o_custkey * 3) AS gene_name")
    return genes(spark, d).join(wanted, "gene_name", "left_semi").select("gene_name", "chrom", "feature", "start", "stop", "strand", "length")


HEADLINE = ("revised_annotation", "overlap_left", "density_sparse", "stranded_density", "density_slice", "gene_te_columns", "gene_top_bottom", "mean_density_by_window", "syntelog_diff", "outlier_genes_p99", "te_length_median")
