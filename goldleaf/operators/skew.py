"""A lookup join that holds when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str, spread_by: str) -> DataFrame:
    """Left join to a lookup with one row per key, safe under hot keys.

    Rows with a NULL key never match; they are not shuffled and come back beside
    the others.  A key is hot if it has more than a task's share of the rest: there
    are fewer such keys than shuffle partitions, so their list may be broadcast.
    The rows of a hot key get a salt from a hash of ``spread_by`` (a column that
    differs within a key), two salts for each share that it has, and only hot
    lookup rows are copied.  The hash makes a repeated task send its rows to the
    same places.  ``facts`` is read four times; pass a stored table where making
    it is work.
    """
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known, unknown = facts.where(F.col(on).isNotNull()), facts.where(F.col(on).isNull())
    total = known.agg(F.count(F.lit(1))).scalar()
    share = F.col("_n") * F.lit(tasks) / total
    hot = (
        known.groupBy(on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(share > 1)
        .select(on, F.ceil(2 * share).cast("int").alias("_salts"))
    )
    salts = F.coalesce("_salts", F.lit(1))
    salted = known.join(F.broadcast(hot), on, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), salts).cast("int"))
    copies = lookup.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    added = [f for f in lookup.schema.fields if f.name != on]
    names = [on, *[c for c in facts.columns if c != on], *[f.name for f in added]]
    return (
        salted.drop("_salts")
        .join(copies.drop("_salts"), [on, "_salt"], "left")
        .select(*names)
        .unionByName(unknown.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added}).select(*names))
    )
