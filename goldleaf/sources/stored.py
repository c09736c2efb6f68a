"""Partitioned tables in a folder, changed a partition at a time.

A change names the partitions it is about and leaves the files of all others
as they are, so its cost follows the change and not the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.sources.tables import conditional_update


def _files(spark: SparkSession, path: str):
    """Spark's file system for a path, and the path as it takes it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def _children(spark: SparkSession, path: str) -> list[str]:
    files, at = _files(spark, path)
    return [status.getPath().getName() for status in files.listStatus(at)]


class PartitionedTable:
    """A parquet table under ``path``, one folder per combination of ``keys``.

    The schema is declared, with the keys last: folder names alone would make
    the key "007" a number.  Without files the table is empty.  One writer at a
    time; readers that began before a change may have to begin again.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: Sequence[str]) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def replace(self, rows: DataFrame) -> None:
        """The partitions that ``rows`` has hold those rows alone from now on.

        Repeating it, after a failure as well, gives the same.  ``rows`` must not
        read the table; see ``apply``.
        """
        (
            rows.select(*self.schema.names)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.keys)
            .parquet(self.path)
        )

    def apply(self, step: str, make: Callable[[], DataFrame]) -> None:
        """Replace partitions by rows that may be made from the table itself, once for each ``step``.

        The rows are written beside the table first.  A step repeated after a
        failure takes them again, instead of making them from a table that it
        has changed in part already.  The rows of earlier steps go.
        """
        pending = f"{self.path}__pending"
        made = f"{pending}/{step}"
        if not exists(self.spark, f"{made}/_SUCCESS"):
            make().select(*self.schema.names).write.mode("overwrite").parquet(made)
            for other in _children(self.spark, pending):
                if other != step:
                    remove(self.spark, f"{pending}/{other}")
        self.replace(self.spark.read.schema(self.schema).parquet(made))

    def touched(self, where: Column) -> list[tuple]:
        """The partitions with a row that meets the predicate."""
        rows = self.read().where(F.coalesce(where, F.lit(False))).select(*self.keys).distinct()
        return sorted((tuple(r) for r in rows.collect()), key=str)

    def within(self, partitions: Sequence[tuple]) -> Column:
        """A filter that Spark applies to the folders, before it opens files."""
        one = [reduce(and_, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(self.keys, values)]) for values in partitions]
        return reduce(or_, one, F.lit(False))

    def update(self, step: str, changes: Mapping[str, Any], where: Column) -> list[tuple]:
        """Set columns where the predicate is true; returns the partitions rewritten.

        Only partitions with such a row are read as a whole and written.
        """
        if moved := set(changes) & set(self.keys):
            raise ValueError(f"an update in place can't move rows between partitions: {sorted(moved)}")
        partitions = self.touched(where)
        if partitions:
            self.apply(step, lambda: conditional_update(self.read().where(self.within(partitions)), changes, where))
        return partitions

    def add(self, step: str, added: DataFrame, sums: Sequence[str]) -> None:
        """Add a delta to stored sums, once for each ``step``.

        ``added`` has the table's columns; rows that agree in all but ``sums``
        become one, with the sums of both.  Partitions that the delta has no row
        of are neither read nor written.
        """
        group = [c for c in self.schema.names if c not in sums]

        def merged() -> DataFrame:
            partitions = [tuple(r) for r in added.select(*self.keys).distinct().collect()]
            together = self.read().where(self.within(partitions)).unionByName(added.select(*self.schema.names))
            return together.groupBy(*group).agg(*[F.sum(c).cast(self.schema[c].dataType).alias(c) for c in sums])

        self.apply(step, merged)
