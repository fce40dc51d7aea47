"""Genes that arrive as a stream against a fixed annotation: a stream-static overlap join without state."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from locusweave.operators.density import dense_density
from locusweave.sources.sinks import write_density


def stream_density(genes: DataFrame, revised: DataFrame, windows: Iterable[int], path: str, checkpoint: str):
    """Appends the cube of each batch of genes to `path`; a batch that is run again overwrites nothing else, as it has a folder of its own."""
    windows = list(windows)

    def batch(rows: DataFrame, number: int) -> None:
        write_density(dense_density(rows, revised, windows), f"{path}/batch={number}")

    return genes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
