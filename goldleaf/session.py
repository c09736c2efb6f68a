"""Session settings the operators were designed for."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale.  Adaptive execution picks partition counts and
# splits skewed shuffle partitions at run time, and only broadcasts a side whose
# measured size is under spark.sql.autoBroadcastJoinThreshold.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: str = "*", shuffle_partitions: int = 8, app: str = "goldleaf") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="goldleaf-warehouse-"))
    )
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Only for sessions inside one local JVM; removed when Python ends.
_own_folder: list[tempfile.TemporaryDirectory] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in spark.checkpoint.dir.

    Where that is unset, a session inside a single local JVM gets a folder of its
    own; any other session must set it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.TemporaryDirectory(prefix="goldleaf-shared-"))
    return _own_folder[0].name


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{shared_dir(spark).rstrip('/')}/goldleaf-{spark.sparkContext.applicationId}"


def remove_run_dir(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; DataFrames that read them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def run(spark: SparkSession) -> Iterator[SparkSession]:
    """A run that owns its intermediate tables: they are gone when it ends."""
    try:
        yield spark
    finally:
        remove_run_dir(spark)
