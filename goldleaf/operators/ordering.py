"""Places and texts in order, over more rows than one task should sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.sources.tables import materialize


def in_ranges(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Adds ``_range``: numbers of ranges of about equal size, rising with the order."""
    return rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())


def numbered(rows: DataFrame, group: str, order: Sequence[Column | str], into: str = "place") -> DataFrame:
    """Adds the place of each row in its group, from 1.

    Rows are numbered within ranges, and the sizes of the ranges before are
    added.  The ranges are stored: numbers and sizes are separate passes.
    """
    placed = materialize(in_ranges(rows, [group, *order]), "in-ranges")
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(group, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(group, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(group, "_range").orderBy(*order)
    return (
        placed.withColumn("_within", F.row_number().over(within))
        .join(starts, [group, "_range"])
        .select(*rows.columns, (F.col("_within") + F.col("_before")).alias(into))
    )


def joined_text(
    rows: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], text: str, separator: str
) -> DataFrame:
    """The texts of each key in order as one text: keys and ``text``.

    ``block`` rises with the order; each block becomes a string, and the strings
    are joined in the order of the blocks.  Null texts are left out.
    """

    def ordered(by: Sequence[str]) -> Column:
        pairs = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(*by, text))))
        return F.array_join(F.transform(pairs, lambda pair: pair[text]), separator).alias(text)

    parts = rows.groupBy(*keys, block).agg(ordered(order), F.count(text).alias("_n"))
    return parts.where(F.col("_n") > 0).groupBy(*keys).agg(ordered([block]))
