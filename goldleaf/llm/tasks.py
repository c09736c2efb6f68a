"""Arrow functions of this package as Spark tasks."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
_shipped: set[str] = set()
# Of a worker: what its functions keep for later tasks, and the function that ran last.
_kept: list[Callable] = []
_last: list[Callable] = []
# On the driver alone: Spark's file server hands the archive to the executors from here.
_folder = tempfile.TemporaryDirectory(prefix="goldleaf-tasks-")


def ship(spark: SparkSession) -> None:
    """Let Spark send this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = Path(_folder.name) / f"{PACKAGE.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(path, "w") as file:
        for source in sorted(PACKAGE.rglob("*.py")):
            file.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def kept(most: int) -> Callable[[Callable], Callable]:
    """``lru_cache(most)`` whose results a worker keeps only as long as its tasks run the same function."""

    def keep(function: Callable) -> Callable:
        _kept.append(lru_cache(most)(function))
        return _kept[-1]

    return keep


def _begin(function: Callable) -> None:
    """A worker serves the functions of all jobs in turn; what another one has kept goes."""
    while isinstance(function, partial):
        function = function.func
    if _last != [function]:
        for cache in _kept:
            cache.cache_clear()
        _last[:] = [function]


def _give_back() -> None:
    """Return freed memory to the system; workers stay for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _task(batches: Iterator[pa.RecordBatch], function: Callable) -> Iterator[pa.RecordBatch]:
    try:
        _begin(function)
        yield from function(batches)
    finally:
        _give_back()


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package.

    Where the session has Spark's default number of rows in a batch, BATCH_ROWS
    are taken: texts are long.
    """
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    return df.mapInArrow(partial(_task, function=function), schema)
