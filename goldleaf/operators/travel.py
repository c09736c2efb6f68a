"""Travel medallion: validated bookings and four gold aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_booking() -> Column:
    """Positive amount and check-out after check-in.

    NULL on either side gives NULL, which a filter drops and count_if leaves out.
    The plain conjunction lets Spark push each part to the scan.
    """
    return (F.col("total_amount") > 0) & (F.col("check_out") > F.col("check_in"))


def silver_bookings(bookings: DataFrame, properties: DataFrame, destinations: DataFrame) -> DataFrame:
    """One enriched row per valid booking.

    The dimensions are joined one after the other, so that Spark judges each by its
    own size (a join of the two is estimated far too large): with small ones the
    bookings are not shuffled at all.  Where properties are too many to broadcast,
    both inputs of that join are plain exchanges, which lets adaptive execution
    split a property that holds a large share of the bookings.
    """
    offers = properties.select(
        "property_id", "destination_id", F.col("title").alias("property_title"), "property_type"
    )
    places = destinations.select("destination_id", "destination", "country", "state_or_province")
    return (
        bookings.filter(valid_booking())
        .join(offers, "property_id")
        .join(places, "destination_id")
        .select(
            "booking_id",
            "property_id",
            "destination_id",
            "property_title",
            "property_type",
            "destination",
            "country",
            "state_or_province",
            "check_in",
            "check_out",
            F.datediff("check_out", "check_in").alias("nights"),
            "guests_count",
            "total_amount",
            "status",
            F.date_trunc("month", "check_in").alias("booking_month"),
        )
    )


def _booking_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_bookings"),
        F.round(F.sum("total_amount"), 2).alias("total_revenue"),
        F.round(F.avg("total_amount"), 2).alias("avg_booking_value"),
    ]


def gold_revenue_by_destination(silver: DataFrame) -> DataFrame:
    return silver.groupBy("destination", "country").agg(
        *_booking_measures(), F.round(F.avg("nights"), 1).alias("avg_nights")
    )


def gold_monthly_revenue(silver: DataFrame) -> DataFrame:
    return silver.groupBy("booking_month").agg(*_booking_measures())


def gold_revenue_by_property_type(silver: DataFrame) -> DataFrame:
    return silver.groupBy("property_type").agg(*_booking_measures())


def gold_payment_methods(payments: DataFrame, silver: DataFrame) -> DataFrame:
    """Completed payments of valid bookings per method.

    A booking with several rows counts its payments several times, as the plain
    join does.  Both sides are summed per booking before they meet: a booking id
    with very many payments or rows is combined on the map side and never
    multiplied out.
    """
    paid = (
        payments.filter((F.col("status") == "completed") & F.col("booking_id").isNotNull())
        .groupBy("booking_id", "payment_method")
        .agg(F.count(F.lit(1)).alias("payments"), F.sum("amount").alias("paid"))
    )
    booked = silver.groupBy("booking_id").agg(F.count(F.lit(1)).alias("copies"))
    return (
        paid.join(booked, "booking_id")
        .groupBy("payment_method")
        .agg(
            F.sum(F.col("payments") * F.col("copies")).alias("payment_count"),
            F.round(F.sum(F.col("paid") * F.col("copies")), 2).alias("total_paid"),
        )
    )


def destinations_per_country(destinations: DataFrame) -> DataFrame:
    """Names joined in sorted order (a collected order would differ between runs)."""
    return destinations.groupBy("country").agg(
        F.count(F.lit(1)).alias("destination_count"),
        F.concat_ws(", ", F.array_sort(F.collect_list("destination"))).alias("destinations"),
    )


def destination_price_stats(destinations: DataFrame, properties: DataFrame) -> DataFrame:
    """Property count and price range per destination name, zero where there is none.

    Prices are combined per destination id before the join, so a destination
    with a third of all properties is one row per map task in the shuffle.
    """
    prices = (
        properties.filter(F.col("destination_id").isNotNull())
        .groupBy("destination_id")
        .agg(
            F.count("property_id").alias("n"),
            F.min("base_price").alias("low"),
            F.max("base_price").alias("high"),
            F.sum("base_price").alias("total"),
            F.count("base_price").alias("priced"),
        )
    )
    return (
        destinations.select("destination_id", "destination", "country")
        .join(prices, "destination_id", "left")
        .groupBy("destination", "country")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("property_count"),
            F.round(F.min("low"), 0).alias("min_price"),
            F.round(F.try_divide(F.sum("total"), F.sum("priced")), 0).alias("avg_price"),
            F.round(F.max("high"), 0).alias("max_price"),
        )
    )


def travel_layer_counts(
    bookings: DataFrame, properties: DataFrame, destinations: DataFrame
) -> DataFrame:
    """Bronze and silver booking counts, with lost rows split by cause.

    Rows lost on the way to silver are either invalid or have no property and
    destination; the two causes are reported apart.  One pass over the bookings.
    """
    known = (
        properties.select("property_id", "destination_id")
        .join(destinations.select("destination_id"), "destination_id")
        .groupBy("property_id")
        .agg(F.count(F.lit(1)).alias("matches"))
    )
    per_property = (
        bookings.groupBy("property_id")
        .agg(
            F.count(F.lit(1)).alias("bronze"),
            F.count_if(valid_booking()).alias("valid"),
        )
        .join(known, "property_id", "left")
    )
    totals = per_property.agg(
        F.coalesce(F.sum("bronze"), F.lit(0)).alias("bronze"),
        F.coalesce(F.sum(F.col("bronze") - F.col("valid")), F.lit(0)).alias("invalid"),
        F.coalesce(F.sum(F.when(F.col("matches").isNull(), F.col("valid"))), F.lit(0)).alias("unmatched"),
        F.coalesce(F.sum(F.col("valid") * F.col("matches")), F.lit(0)).alias("silver"),
    )
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(label).alias("layer"), F.col(column).alias("n_rows"))
                    for label, column in [
                        ("bronze_bookings", "bronze"),
                        ("lost_invalid", "invalid"),
                        ("lost_unmatched", "unmatched"),
                        ("silver_bookings", "silver"),
                    ]
                ]
            )
        )
    )
