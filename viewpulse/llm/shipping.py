"""Python functions on the executors: the package travels with the session, so workers need no installation of it."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors of the session's application, once; Spark distributes the archive."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="viewpulse-code-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def tidied(function: Callable) -> Callable:
    """`function`, which hands freed memory back to the system at the end of a task: a worker stays for later stages, and beside
    it the executor needs the room for those that run without Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)

    return run


def in_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """`df.mapInArrow` with this package at hand."""
    ship(df.sparkSession)
    return df.mapInArrow(tidied(function), schema)
