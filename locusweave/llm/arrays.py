"""Read-only numpy arrays that tasks map into memory instead of holding them: written to the shared folder, fetched once by each executor."""

from __future__ import annotations

import io

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from .common import fresh_path

#: Bytes that go to the file system at once.
STEP = 1 << 23


def ship(spark: SparkSession, what: str, arrays: dict[str, np.ndarray]) -> dict[str, str]:
    """Writes each array as a file of the shared folder, which every executor (also one that replaces a lost one) fetches; names for opened()."""
    context, names = spark.sparkContext, {}
    base = fresh_path(spark, what)
    for key, array in arrays.items():
        data = io.BytesIO()
        np.save(data, np.ascontiguousarray(array))
        path = context._jvm.org.apache.hadoop.fs.Path(f"{base}-{key}.npy")
        out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
        view = data.getbuffer()
        for at in range(0, len(view), STEP):
            out.write(bytearray(view[at : at + STEP]))
        out.close()
        context.addFile(path.toString())
        names[key] = path.getName()
    return names


def opened(names: dict[str, str]) -> dict[str, np.ndarray]:
    """The arrays by their keys, memory-mapped; to be called in a task."""
    out = {}
    for key, name in names.items():
        path = SparkFiles.get(name)
        try:
            out[key] = np.load(path, mmap_mode="r")
        except ValueError:  # nothing to map in an empty array
            out[key] = np.load(path)
    return out
