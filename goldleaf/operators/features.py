"""Customer features, spend tiers and the stratified split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIER_CUTS = (0.33, 0.66)


def customer_features(silver: DataFrame, as_of: Column) -> DataFrame:
    """Spend, counts and recency per customer.  ``as_of`` replaces the clock.

    The distinct count is planned as a grouping by (customer, product) first, so
    a customer with very many sales is combined before the shuffle.
    """
    return (
        silver.groupBy("customerID")
        .agg(
            F.sum("total_price").alias("total_spend"),
            F.count("transactionID").alias("transaction_count"),
            F.count_distinct("product").alias("distinct_products"),
            F.max("transaction_date").alias("last_purchase_date"),
        )
        .withColumn("days_since_last_purchase", F.datediff(as_of, "last_purchase_date"))
        .drop("last_purchase_date")
    )


def approximate_cuts(features: DataFrame, column: str = "total_spend") -> DataFrame:
    """Cut points from a mergeable sketch, relative error 0.01: low_cut, high_cut."""
    cuts = F.percentile_approx(column, F.array(*[F.lit(p) for p in TIER_CUTS]), 100)
    return features.agg(cuts.alias("cuts")).select(
        F.col("cuts")[0].alias("low_cut"), F.col("cuts")[1].alias("high_cut")
    )


def range_counts(values: DataFrame, brackets: list[tuple[float, float]], ranges: int) -> DataFrame:
    """(cut, range, n, low, high) of rows (v): each bracket in ``ranges`` even ranges, counted map side first."""
    each = F.array(*[F.struct(F.lit(k).alias("cut"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b) in enumerate(brackets)])
    v = F.col("v")
    place = F.when(F.col("b") > F.col("a"), F.floor((v / ranges - F.col("a") / ranges) / (F.col("b") / ranges - F.col("a") / ranges) * ranges))
    return (
        values.select("v", F.inline(each))
        .where((v >= F.col("a")) & (v <= F.col("b")))
        .groupBy("cut", F.least(F.coalesce(place, F.lit(0)), F.lit(ranges - 1)).alias("range"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )


def exact_cuts(features: DataFrame, column: str = "total_spend", ranges: int = 1024) -> DataFrame:
    """The values at ranks ceil(p * n), found by counting: low_cut, high_cut.

    Values are counted per range, the range that holds the rank is divided again,
    and so on until it holds one value.  No rows are sorted and none meet in one
    task; the driver sees at most ``ranges`` counts for each cut and round, and a
    round makes the brackets at least one value narrower, for common values about
    ``ranges`` times.  ``features`` is read once a round; pass a stored table.
    NULLs don't count; without values both cuts are NULL.
    """
    spark = features.sparkSession
    values = features.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    n, low, high = values.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    schema = "low_cut double, high_cut double"
    if not n:
        return spark.createDataFrame([(None, None)], schema)
    brackets = [(low, high)] * len(TIER_CUTS)
    ranks = [max(math.ceil(p * n), 1) for p in TIER_CUTS]
    while any(a < b for a, b in brackets):
        counts = sorted(range_counts(values, brackets, ranges).collect(), key=lambda r: (r.cut, r.range))
        for cut in range(len(brackets)):
            for r in (r for r in counts if r.cut == cut):
                if ranks[cut] <= r.n:
                    brackets[cut] = (r.low, r.high)
                    break
                ranks[cut] -= r.n
    return spark.createDataFrame([tuple(a for a, _ in brackets)], schema)


def with_spend_tier(features: DataFrame, cuts: DataFrame, column: str = "total_spend") -> DataFrame:
    """Tier 0 up to the low cut, 1 up to the high cut, 2 above.

    The cuts are one row and enter the plan as one scalar value.
    """
    value = F.col(column)
    both = cuts.select(F.struct("low_cut", "high_cut")).scalar()
    return features.withColumn(
        "spend_tier",
        F.when(value <= both["low_cut"], 0).when(value <= both["high_cut"], 1).otherwise(2),
    )


def stratified_split(
    rows: DataFrame, label: str, id_column: str, test_share: float = 0.25, seed: int = 42, digits: int = 4
) -> DataFrame:
    """Adds ``split`` (train, test): exactly ceil(share * n) test rows per label.

    Rows are ordered by a hash of id and seed, so the split depends on neither
    partitioning nor retries.  A label may hold a third of all rows, so no label
    is sorted in one task: rows are numbered within (label, hash prefix), and
    only the counts per prefix are accumulated per label.
    """
    digest = F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}")))
    keyed = rows.withColumns(
        {
            # NULL labels are a group of their own; a plain key keeps one partitioning for all steps
            "_label": F.coalesce(F.col(label).cast("string"), F.lit("")),
            "_order": digest,
        }
    ).withColumn("_prefix", F.substring("_order", 1, digits))
    sizes = keyed.groupBy("_label", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    in_label = Window.partitionBy("_label")
    before = F.sum("_n").over(in_label.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(
        "_label",
        "_prefix",
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.ceil(F.sum("_n").over(in_label) * F.lit(test_share)).alias("_wanted"),
    )
    within = Window.partitionBy("_label", "_prefix").orderBy("_order", id_column)
    numbered = keyed.withColumn("_place", F.row_number().over(within))
    return numbered.join(starts, ["_label", "_prefix"]).select(
        *rows.columns,
        F.when(F.col("_before") + F.col("_place") <= F.col("_wanted"), "test").otherwise("train").alias("split"),
    )
