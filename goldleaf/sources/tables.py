"""Table reads, writes and checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.session import run_dir

PROFILE_SCHEMA = "table_name string, column_name string, column_type string, n_rows bigint, n_null bigint, error string"

SAMPLE_ROWS, SAMPLE_CHARS = 5, 40


def bronze(source: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Raw copy plus the ingestion time."""
    return source.withColumn("_ingested_at", F.current_timestamp() if ingested_at is None else ingested_at)


def save_overwrite(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> None:
    """Create or replace a table with the rows of a query that does not read it."""
    writer = df.write.mode("overwrite").format("parquet")
    keys = list(partition_by)
    (writer.partitionBy(*keys) if keys else writer).saveAsTable(name)


def append_rows(df: DataFrame, name: str) -> None:
    """Add rows to a result history; the table is created on first use."""
    df.write.mode("append").format("parquet").saveAsTable(name)


def record_rows(df: DataFrame, name: str, key: str) -> None:
    """Add rows to a history that has a partition per ``key``.

    A repeated job replaces the partitions of its own keys; the others are
    neither read nor written, so the cost is that of the new rows.  The table is
    created on first use, with the key as its last column.
    """
    spark = df.sparkSession
    rows = df.select(*[c for c in df.columns if c != key], key)
    if not spark.catalog.tableExists(name):
        rows.limit(0).write.format("parquet").partitionBy(key).saveAsTable(name)
    # insertInto knows this setting from the session alone
    setting, before = "spark.sql.sources.partitionOverwriteMode", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set(setting, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


def replace_table(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> None:
    """Create or replace a table with the rows of a query that may read the table itself.

    The new rows are written under another name first and swapped in by two
    renames.  A job lost half-way leaves the old rows under their own name or
    under ``<name>__old``, never nowhere; between the renames readers find no
    table for a moment.
    """
    spark = df.sparkSession
    fresh, old = f"{name}__new", f"{name}__old"
    save_overwrite(df, fresh, partition_by)
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def publish(df: DataFrame, name: str, folder: str) -> str:
    """Create or replace what readers find under ``name``, without a moment in which they find nothing.

    The rows are written to a new version under ``folder`` (on shared storage),
    and then the view changes over to it, in one statement.  A query that began
    on the version before ends on it; ``drop_versions`` removes what no one
    reads any more.  ``df`` may read the name itself.
    """
    version = f"{folder.rstrip('/')}/version-{uuid4().hex}"
    df.write.parquet(version)
    spark = df.sparkSession
    spark.read.parquet(version).createOrReplaceTempView(quoted(name))
    return version


def drop_versions(spark: SparkSession, folder: str, keep: str) -> None:
    """Remove the versions under ``folder`` but one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(at):
        if status.getPath().getName() != keep.rsplit("/", 1)[-1]:
            files.delete(status.getPath(), True)


def quoted(name: str) -> str:
    """An identifier of any characters for a SQL text."""
    return "`" + name.replace("`", "``") + "`"


def read_share(spark: SparkSession, name: str, schema: str | T.StructType) -> DataFrame:
    """A table that someone else maintains, under a name of any characters, as the declared columns.

    Columns may come in any order and with others beside them; they are cast, and
    a value that does not fit becomes null.  A declared column that is not there
    is an error that names it.
    """
    shared = spark.sql(f"SELECT * FROM {quoted(name)}")
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if absent := [f.name for f in declared if f.name not in shared.columns]:
        raise ValueError(f"{name} has no column {', '.join(absent)}")
    return shared.select(*[F.col(quoted(f.name)).try_cast(f.dataType).alias(f.name) for f in declared])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write rows that several later passes read, and read them back.

    The files are in the shared folder of the cluster, so they survive a lost
    executor, and later passes do not run the joins behind them again.  They
    belong to the application's run folder (``session.run`` removes it).
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def conditional_update(df: DataFrame, changes: Mapping[str, Any], where: Column) -> DataFrame:
    """Rows with ``changes`` applied where the predicate is true; others as they were."""
    hit = F.coalesce(where, F.lit(False))
    new = {
        name: F.when(hit, value if isinstance(value, Column) else F.lit(value)).otherwise(F.col(name))
        for name, value in changes.items()
    }
    return df.withColumns(new)


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """One row per column: type, table rows and NULLs, from a single aggregate."""
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                (F.col("n_rows") - F.col(f"c{i}")).alias("n_null"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select("n_rows", F.inline(per_column)).select(
        F.lit(name).alias("table_name"),
        "column_name",
        "column_type",
        "n_rows",
        "n_null",
        F.lit(None).cast("string").alias("error"),
    )


def _sample_text(field: T.StructField) -> Column:
    """A value for display: the start of a text, six decimals of a fraction, the size of a list."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        shown = F.substring(column, 1, SAMPLE_CHARS)
    elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        shown = column.cast("decimal(30,6)").cast("string")
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        shown = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
        shown = F.when(column.isNotNull(), F.concat(F.lit("list of "), F.size(column).cast("string")))
    else:
        shown = column.cast("string")
    return F.coalesce(shown, F.lit("NULL"))


def with_samples(df: DataFrame, name: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """profile_table and ``sample``: each column's values in the first rows, as texts in their order.

    The first rows are those in the order of all columns, so a table has one
    sample whatever its files; each task keeps ``rows`` rows at most.
    """
    fields = df.schema.fields
    orderable = [F.col(f"`{f.name}`") for f in fields if "map<" not in f.dataType.simpleString()]
    first = df.orderBy(*orderable).limit(rows).select(*[_sample_text(f).alias(f"s{i}") for i, f in enumerate(fields)])
    texts = first.agg(F.map_from_arrays(
        F.array(*[F.lit(f.name) for f in fields]),
        F.array(*[F.array_join(F.array_sort(F.collect_list(f"s{i}")), " | ") for i in range(len(fields))]),
    ).alias("samples"))
    return profile_table(df, name).withColumn("sample", F.element_at(texts.scalar(), F.col("column_name")))


def profile_tables(
    spark: SparkSession,
    readers: Mapping[str, Callable[[], DataFrame]],
    profile_of: Callable[[DataFrame, str], DataFrame] = profile_table,
) -> DataFrame:
    """Profiles of several tables; one that cannot be read becomes an error row."""
    profile = None
    for name, read in readers.items():
        try:
            one = profile_of(read(), name)
        except AnalysisException as problem:
            text = str(problem).splitlines()[0]
            one = spark.range(1).select(F.lit(name).alias("table_name"), F.lit(text).alias("error"))
        profile = one if profile is None else profile.unionByName(one, allowMissingColumns=True)
    if profile is None:
        return spark.createDataFrame([], PROFILE_SCHEMA)
    known = T.StructType.fromDDL(PROFILE_SCHEMA)
    for field in known:  # if no table can be read
        if field.name not in profile.columns:
            profile = profile.withColumn(field.name, F.lit(None).cast(field.dataType))
    return profile.select(*known.names, *[c for c in profile.columns if c not in known.names])


def table_sample(df: DataFrame, rows: int = 5) -> DataFrame:
    """First rows for display."""
    return df.limit(rows)


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named layer, as one row each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, df in layers.items()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out
