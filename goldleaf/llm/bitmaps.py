"""A bitmap of fixed size that spares joins most rows without a partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAPS, BITS = 256, 1 << 15


def _marked(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """(row, may): the rows as structs, and whether their key may be among the wanted ones; false without a key."""

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(BITMAPS * BITS))

    bitmaps = (
        wanted.select(place(key).alias("place"))
        .groupBy(F.floor(F.col("place") / BITS).alias("part"))
        .agg(F.bitmap_construct_agg(F.pmod("place", F.lit(BITS))).alias("bitmap"))
    )
    bit = F.expr(f"""
        shiftright(
            cast(conv(hex(substring(bitmap, cast(pmod(place, {BITS}) div 8 AS int) + 1, 1)), 16, 10) AS int),
            cast(pmod(place, 8) AS int)
        ) & 1 = 1
    """)
    return (
        rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
        .withColumn("place", place(f"row.{key}"))
        .withColumn("part", F.floor(F.col("place") / BITS))
        .join(F.broadcast(bitmaps), "part", "left")
        .select("row", (F.coalesce(bit, F.lit(False)) & F.col(f"row.{key}").isNotNull()).alias("may"))
    )


def possible(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` may be among the wanted ones, by a bitmap of BITMAPS x 32,768 bits.

    The bitmap has one size whatever the input, 1 MB, so it may be broadcast; the
    more keys are wanted, the less it spares the exact join that must follow.
    Rows without a key go.
    """
    return _marked(rows, wanted, key).where("may").select("row.*")


def without_keys(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not in ``gone``; rows without a key stay.

    Only rows that the bitmap can't clear are dealt out for the exact join.
    """
    marked = _marked(rows, gone, key)
    gone = gone.select(F.col(key).alias("gone")).distinct().hint("merge")
    unsure = marked.where("may").select("row")
    return (
        marked.where("NOT may")
        .select("row")
        .unionByName(unsure.join(gone, F.col(f"row.{key}") == gone["gone"], "left_anti"))
        .select("row.*")
    )


def one_of_each(rows: DataFrame, repeated: DataFrame, key: str) -> DataFrame:
    """One row, the least by its other columns, of each key in ``repeated``; rows with other keys, which must be unlike, stay.

    Only rows that the bitmap can't clear are dealt out.
    """
    marked = _marked(rows, repeated, key)
    unsure = marked.where("may").groupBy(F.col(f"row.{key}").alias("key")).agg(F.min("row").alias("row"))
    return marked.where("NOT may").select("row").unionByName(unsure.select("row")).select("row.*")
