"""Readers: cleaned tables, raw GFF, repeat tables, gene pairs, expression matrices, windows from an INI file."""

from __future__ import annotations

import configparser
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.functions import checks
from locusweave.schema import DENSITY, GENES, REVISED, TES

#: What the text readers take for a missing value.
MISSING = ("", "NA", "NULL", "NaN", "nan", "null", "N/A", "n/a", "#N/A")
GFF = ("chrom", "software", "feature", "start", "stop", "score", "strand", "frame", "attributes")


def whole(column: Column) -> Column:
    """Text such as 500 or 500.0 as BIGINT, exactly; null if it is no number."""
    return column.try_cast("decimal(38,6)").try_cast("bigint")


def known(column: Column) -> Column:
    return F.when(~column.isin(*MISSING), column)


def clean_genes(raw: DataFrame) -> DataFrame:
    """Columns Gene_Name, Chromosome, Feature, Start, Stop, Strand, Length as genes; a strand of . counts as +."""
    strand = known(F.col("Strand"))
    return raw.select(
        known(F.col("Chromosome")).alias("chrom"), known(F.col("Gene_Name")).alias("gene_name"), known(F.col("Feature")).alias("feature"),
        whole(F.col("Start")).alias("start"), whole(F.col("Stop")).alias("stop"), F.when(strand == ".", "+").otherwise(strand).alias("strand"), whole(F.col("Length")).alias("length"),
    )


def clean_tes(raw: DataFrame) -> DataFrame:
    return raw.select(
        known(F.col("Chromosome")).alias("chrom"), whole(F.col("Start")).alias("start"), whole(F.col("Stop")).alias("stop"), known(F.col("Strand")).alias("strand"),
        known(F.col("Order")).alias("te_order"), known(F.col("SuperFamily")).alias("superfamily"), whole(F.col("Length")).alias("length"),
    )


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True)


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned gene table (tab-separated, with a header); names must be unique and strands known."""
    raw = _table(spark, path)
    checks.require(checks.bad_strands(raw.select(F.col("Strand").alias("strand"))), "strands other than + - .")
    genes = clean_genes(raw)
    checks.require(checks.repeated_names(genes), "gene names that occur more than once")
    return genes


def read_tes(spark: SparkSession, path: str) -> DataFrame:
    return clean_tes(_table(spark, path))


def fields(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """Lines of text (value) split at runs of tabs, what follows a # being a comment anywhere in a line."""
    parts = lines.select(F.split(F.regexp_replace("value", "#.*$", ""), "\t+").alias("p")).where("size(p) > 1")
    return parts.select(*(known(F.get("p", F.lit(i))).alias(n) for i, n in enumerate(names)))


def attribute(column: Column, pattern: str) -> Column:
    """The first group of a pattern; null without a match."""
    return F.nullif(F.regexp_extract(column, pattern, 1), F.lit(""))


def gff_genes(lines: DataFrame, name: str = r"ID=(.*?);", feature: str = "gene") -> DataFrame:
    """Genes of a raw GFF; rows with a missing value go."""
    rows = fields(lines, GFF).where(F.col("feature") == feature)
    out = rows.select("chrom", attribute(F.col("attributes"), name).alias("gene_name"), "feature", whole(F.col("start")).alias("start"), whole(F.col("stop")).alias("stop"), "score", "strand", "frame")
    return out.withColumn("length", F.col("stop") - F.col("start") + 1).dropna("any").drop("score", "frame")


def read_gff_genes(spark: SparkSession, path: str, name: str = r"ID=(.*?);") -> DataFrame:
    return gff_genes(spark.read.text(path), name)


def gff_tes(lines: DataFrame, renamer=None) -> DataFrame:
    """Elements of an EDTA GFF: Classification=Order/SuperFamily. A missing classification is the text nan, a missing second part None."""
    rows = fields(lines, GFF)
    parts = F.split(attribute(F.col("attributes"), r"Classification=(.*?);"), "/")
    out = rows.select(
        "chrom", whole(F.col("start")).alias("start"), whole(F.col("stop")).alias("stop"), F.coalesce("strand", F.lit("nan")).alias("strand"),
        F.coalesce(F.get(parts, F.lit(0)), F.lit("nan")).alias("te_order"),
        F.coalesce(F.get(parts, F.lit(1)), F.when(parts.isNull(), "nan").otherwise("None")).alias("superfamily"),
    )
    out = out.transform(renamer) if renamer else out
    return out.withColumn("length", F.col("stop") - F.col("start") + 1)


def read_gff_tes(spark: SparkSession, path: str, renamer=None) -> DataFrame:
    return gff_tes(spark.read.text(path), renamer)


def repeat_table(raw: DataFrame, chromosomes: Sequence[str] | None = None, renamer=None, zero_based: bool = False) -> DataFrame:
    """Elements of a UCSC repeat table. Its starts are 0-based; zero_based=True corrects them, by default they are taken as they are."""
    start = whole(F.col("genoStart")) + (1 if zero_based else 0)
    out = raw.select(F.col("genoName").alias("chrom"), start.alias("start"), whole(F.col("genoEnd")).alias("stop"), "strand", F.col("repClass").alias("te_order"), F.col("repFamily").alias("superfamily"))
    out = out.where(F.col("chrom").isin(*chromosomes)) if chromosomes else out
    out = out.withColumn("length", F.col("stop") - F.col("start") + 1)
    return out.transform(renamer) if renamer else out


PAIRS = ("a_chrom", "a_region", "a_start", "a_stop", "b_chrom", "b_region", "b_start", "b_stop", "e_value", "diagonal_score", "link")


def gene_pairs(lines: DataFrame, chromosomes: Sequence[str] = tuple(map(str, range(1, 13))), most: float = 0.05) -> DataFrame:
    """Pairs of genes on chromosomes of the same number: chrom, gene_a, gene_b, e_value under `most`."""
    rows = fields(lines, PAIRS)
    part = lambda c, at, i: F.get(F.split(c, at), F.lit(i))
    rows = rows.withColumns({c: part(F.col(c), r"\|\|", 3) for c in ("a_region", "b_region")})
    rows = rows.where(~F.col("a_region").contains("transcript") & ~F.col("b_region").contains("transcript"))
    a = part(part(F.col("a_region"), "CDS:", 1), r"\.", 0)
    b = F.translate(part(part(F.col("b_region"), "CDS:", 1), "-", 0), "t", "g")
    out = rows.select(
        part(F.col("a_chrom"), "_", 1).alias("chrom"), a.alias("gene_a"), part(F.col("b_chrom"), "_", 1).alias("__other"), b.alias("gene_b"), F.col("e_value").try_cast("double").alias("e_value")
    )
    return out.where((F.col("e_value") < most) & (F.col("chrom") == F.col("__other")) & F.col("chrom").isin(*chromosomes)).drop("__other")


def read_gene_pairs(spark: SparkSession, path: str) -> DataFrame:
    return gene_pairs(spark.read.text(path))


def read_orthologs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, nullValue="NA")


def read_expression(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A matrix of one gene name and one number per library; the header names the libraries."""
    raw = spark.read.csv(path, sep=sep, header=True)
    return raw.select(F.col(raw.columns[0]).alias("gene_name"), *(F.col(f"`{c}`").try_cast("double").alias(c) for c in raw.columns[1:]))


def one_library(matrix: DataFrame, library: str) -> DataFrame:
    """gene_name and log10(x + 1) of one library."""
    return matrix.select("gene_name", F.log10(F.col(f"`{library}`") + 1).alias("expression"))


def read_fpkm(spark: SparkSession, path: str, library: str, gene: str = "Gene", sep: str = ",") -> DataFrame:
    """gene_name and log10(x + 1) of one library of a table with many columns; only these two are read."""
    raw = spark.read.csv(path, sep=sep, header=True)
    return raw.select(F.col(f"`{gene}`").alias("gene_name"), F.log10(F.col(f"`{library}`").try_cast("double") + 1).alias("expression"))


def prefix_chromosomes(rows: DataFrame, prefix: str) -> DataFrame:
    """Chromosome names with a text before them, as where scaffolds are only numbered."""
    return rows.withColumn("chrom", F.concat(F.lit(prefix), "chrom"))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """One gene name a line."""
    return spark.read.text(path).select(F.trim("value").alias("gene_name")).where("gene_name <> ''")


def windows_from_ini(path: str) -> range:
    """first_window_size to last_window_size, inclusive, in steps of window_delta."""
    config = configparser.ConfigParser()
    if not config.read(path):
        raise FileNotFoundError(path)
    first, delta, last = (config.getint("density_parameters", k) for k in ("first_window_size", "window_delta", "last_window_size"))
    return range(first, last + 1, delta)


#: Lines of a file whose headers one task numbers.
RUN_OF_LINES = 1 << 20


def rename_sequences(lines: DataFrame, listed: Sequence[str], prefix: str = "Auxiliary_") -> DataFrame:
    """FASTA headers (line, value): a listed id keeps its name; the others are numbered by order in the file.

    Headers are numbered within runs of lines, and what stands before a run comes from a table with one row per run.
    """
    from pyspark.sql import Window as W

    name = F.get(F.split(F.substring("value", 2, 1 << 30), r"\s+"), F.lit(0))
    heads = lines.where(F.col("value").startswith(">")).withColumn("id", name)
    known_ids = heads.where(F.col("id").isin(*listed)).select("line", F.col("id").alias("name"))
    others = heads.where(~F.col("id").isin(*listed)).select("line", F.floor(F.col("line") / RUN_OF_LINES).alias("run"))
    before = F.coalesce(F.sum("n").over(W.orderBy("run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = others.groupBy("run").agg(F.count("*").alias("n")).select("run", before.alias("before"))
    nth = F.row_number().over(W.partitionBy("run").orderBy("line")) + F.col("before")
    numbered = others.join(runs, "run").select("line", F.concat(F.lit(prefix), nth).alias("name"))
    return lines.join(known_ids.unionByName(numbered), "line", "left").select("line", F.coalesce(F.concat(F.lit(">"), "name"), "value").alias("value"))


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """path, length and modificationTime of the files under a folder (or of one file) whose names end in `suffix`, subfolders
    included, by path. Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", f"*{suffix}") if suffix else reader
    return reader.load(folder).select("path", "length", "modificationTime").orderBy("path")


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of ours, by its schema: partition values such as 01 stay text."""
    return spark.read.schema(schema).parquet(path)


def read_revised(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, REVISED)


def read_cached_genes(spark: SparkSession, path: str, chrom: str | None = None) -> DataFrame:
    """Genes as written by sinks.write_cache, of one chromosome if one is named; they must be of one genome."""
    return _cached(_stored(spark, path, GENES), chrom)


def read_cached_tes(spark: SparkSession, path: str, chrom: str | None = None) -> DataFrame:
    return _cached(_stored(spark, path, TES), chrom)


def _cached(rows: DataFrame, chrom: str | None) -> DataFrame:
    rows = rows if chrom is None else rows.where(F.col("chrom") == chrom)
    checks.single_genome(rows)
    return rows


def read_density(spark: SparkSession, path: str, genome_id: str | None = None) -> DataFrame:
    """The density table as written by sinks.write_density; genome and chromosome are partitions and prune."""
    rows = _stored(spark, path, DENSITY)
    return rows if genome_id is None else rows.where(F.col("genome_id") == genome_id)


def read_density_with_genes(spark: SparkSession, path: str, genes: DataFrame) -> DataFrame:
    """The density table of just the chromosomes that `genes` has; an error if either has one that the other lacks."""
    rows = read_density(spark, path)
    checks.require(checks.chromosome_difference(genes, rows), "chromosomes that only the genes or only the densities have")
    return rows


def read_density_files(spark: SparkSession, paths: Sequence[str] | str, pattern: str) -> DataFrame:
    """Density files whose chromosome stands in the file's name, as the pattern's first group; it must agree with the rows."""
    rows = spark.read.parquet(*([paths] if isinstance(paths, str) else paths)).withColumn("__chrom", F.regexp_extract(F.input_file_name(), pattern, 1))
    checks.require(rows.where("NOT chrom <=> __chrom").select("chrom", "__chrom").distinct(), "chromosomes that differ from the file's name")
    return rows.drop("__chrom")
