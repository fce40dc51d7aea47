"""A stored cube: parts that are computed once each, a manifest that says which are whole, mergeable sums, and slices that read little."""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.operators.density import BOTH, GENE, cell_sums, spread
from locusweave.schema import INTRA, LEFT, RIGHT
from locusweave.sources.store import files_at, put_text

log = logging.getLogger(__name__)

#: Bytes of a row group of a stored cube: what a slice reads at least.
ROW_GROUP = 1 << 20
_ORDER = ["te_category", "te_name", "direction", "window"]


def axes_of(windows: Iterable[int], directions: Sequence[str] = (LEFT, INTRA, RIGHT), kinds: Sequence[str] = BOTH) -> str:
    """The axes of sums or of a cube, as a text that is equal for equal ones."""
    return json.dumps([sorted({int(w) for w in windows if w >= 0}), sorted(set(directions)), sorted(set(kinds))])


def partial_sums(genes: DataFrame, revised: DataFrame, windows: Iterable[int], directions: Sequence[str] = (LEFT, INTRA, RIGHT), kinds: Sequence[str] = BOTH) -> DataFrame:
    """Sums of shared bases of some genes, or with some of the intervals, that merge() puts together; each row says its axes."""
    return cell_sums(genes, revised, windows, directions, kinds).withColumn("axes", F.lit(axes_of(windows, directions, kinds)))


def merge(parts: Sequence[DataFrame], windows: Iterable[int], directions: Sequence[str] = (LEFT, INTRA, RIGHT), kinds: Sequence[str] = BOTH) -> DataFrame:
    """The cube of all parts, in any order: whole numbers are added up and divided once at the end.

    Parts may be chunks of genes or of intervals. ValueError if a part has other windows, directions or categories than wanted, or
    if parts of one chromosome disagree on its names where each holds other genes, since then one of them saw other intervals.
    """
    windows = list(windows)
    want = axes_of(windows, directions, kinds)
    rows = parts[0].withColumn("__chunk", F.lit(0))
    for k, p in enumerate(parts[1:], 1):
        if sorted(p.columns) != sorted(parts[0].columns):
            raise ValueError(f"part {k} has other columns: {p.columns}")
        rows = rows.unionByName(p.withColumn("__chunk", F.lit(k)))
    odd = rows.where(F.col("axes") != want).select("__chunk", "axes").take(1)
    if odd:
        raise ValueError(f"part {odd[0]['__chunk']} has axes {odd[0]['axes']}, not {want}")
    sums = [c for c in parts[0].columns if c.startswith("bases_")]
    return spread(rows.groupBy(*GENE, "te_category", "te_name").agg(*(F.sum(c).alias(c) for c in sums)), windows, directions)


def same_names(parts: Sequence[DataFrame]) -> None:
    """ValueError if chunks of genes of one chromosome have other names: one of them saw other intervals."""
    first = None
    for k, p in enumerate(parts):
        names = {(r["chrom"], r["te_category"], r["te_name"]) for r in p.select("chrom", "te_category", "te_name").distinct().collect()}  # names of categories: few
        here = {c for c, *_ in names}
        if first is not None and {n for n in first if n[0] in here} - names:
            raise ValueError(f"part {k} lacks names that others have on its chromosomes")
        if first is not None and {n for n in names if n[0] in {c for c, *_ in first}} - first:
            raise ValueError(f"part {k} has names that others lack on its chromosomes")
        first = names if first is None else first | names


def _name(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:24]


class CubeStore:
    """Parts of cubes under one folder: data/<part>-<run>/ with the rows, manifest/<part>.json once they are all there.

    A part is a genome, a chromosome, a set of axes and a key that stands for the inputs. Its manifest is written after its data, so data
    without one are from a run that was stopped, and are ignored and computed again; parts that are whole are not touched.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, genome: str, chrom: str, axes: str, key: str) -> str:
        return f"{self.root}/manifest/{_name(json.dumps([genome, chrom, axes, key]))}.json"

    def part(self, genome: str, chrom: str, axes: str, key: str) -> dict | None:
        """What the manifest says of a part, if it is whole and its data are there."""
        path, files = files_at(self.spark, self._path(genome, chrom, axes, key))
        if not files.exists(path):
            return None
        said = json.loads("".join(r[0] for r in self.spark.read.text(path.toString()).collect()))
        data, files = files_at(self.spark, f"{said['data']}/_SUCCESS")
        return said if files.exists(data) else None

    def complete(self, genome: str, chroms: Iterable[str], windows: Iterable[int], key: str, make: Callable[[str], DataFrame], directions: Sequence[str] = (LEFT, INTRA, RIGHT), kinds: Sequence[str] = BOTH) -> list[str]:
        """Computes by make(chromosome) the parts that are absent or not whole, one after another; gives the chromosomes it computed."""
        axes, made = axes_of(windows, directions, kinds), []
        for chrom in chroms:
            if self.part(genome, chrom, axes, key):
                continue
            data = f"{self.root}/data/{_name(json.dumps([genome, chrom, axes, key]))}-{uuid.uuid4().hex[:8]}"
            rows = make(chrom)
            # cells of one slice stand together, so that the statistics of row groups keep a slice from reading others
            rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER, "gene_name").write.option("parquet.block.size", ROW_GROUP).option("compression", "zstd").parquet(data)
            said = {"genome": genome, "chrom": chrom, "axes": axes, "key": key, "data": data}
            put_text(self.spark, self._path(genome, chrom, axes, key), json.dumps(said))
            log.info("cube part of %s %s written", genome, chrom)
            made.append(chrom)
        return made

    def read(self, genome: str, chroms: Iterable[str], windows: Iterable[int], key: str, directions: Sequence[str] = (LEFT, INTRA, RIGHT), kinds: Sequence[str] = BOTH) -> DataFrame:
        """The cube of whole parts; ValueError names the chromosomes that have none."""
        axes = axes_of(windows, directions, kinds)
        said = {c: self.part(genome, c, axes, key) for c in chroms}
        if lost := sorted(c for c, s in said.items() if s is None):
            raise ValueError(f"no whole part of {lost[:5]}")
        return self.spark.read.parquet(*(s["data"] for s in said.values()))
