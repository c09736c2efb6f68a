"""Dashboard and report queries; they read gold tables only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.functions.numbers import grouped_number, money
from goldleaf.functions.phrases import TOOL_HEADINGS
from goldleaf.operators.ordering import joined_text, numbered
from goldleaf.sources.tables import materialize

# The gold tables that the tools read, and the lines that a tool shows if not asked for a number (None: all).
TOOL_TABLES = (
    "gold_revenue_by_destination",
    "gold_monthly_revenue",
    "gold_revenue_by_property_type",
    "gold_payment_methods",
)
TOOL_ROWS = {"top_destinations": 5, "monthly_trend": 6, "revenue_by_property_type": None, "payment_methods": None}
BLOCK = 1000  # lines joined at once


def daily_revenue_chart(gold_daily: DataFrame, fill_gaps: bool = False) -> DataFrame:
    """Revenue and transactions per day; with ``fill_gaps`` missing days are zero."""
    per_day = gold_daily.groupBy("transaction_date").agg(
        F.sum("daily_revenue").alias("daily_revenue"),
        F.sum("transaction_count").alias("transaction_count"),
    )
    if not fill_gaps:
        return per_day
    every_day = gold_daily.agg(
        F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last")
    ).select(F.explode(F.sequence("first", "last")).alias("transaction_date"))
    return every_day.join(per_day, "transaction_date", "left").select(
        "transaction_date",
        F.coalesce("daily_revenue", F.lit(0.0)).alias("daily_revenue"),
        F.coalesce("transaction_count", F.lit(0)).alias("transaction_count"),
    )


def top_destinations_chart(gold_destinations: DataFrame, k: int = 10) -> DataFrame:
    """The k best (destination, country) rows, summed by destination after the cut."""
    return (
        gold_destinations.orderBy(F.desc("total_revenue"), "destination", "country")
        .limit(k)
        .groupBy("destination")
        .agg(F.sum("total_revenue").alias("total_revenue"))
    )


def monthly_travel_chart(gold_monthly: DataFrame) -> DataFrame:
    return gold_monthly.groupBy("booking_month").agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_bookings").alias("total_bookings"),
    )


# ---- reports: rows plus the text line a reader gets ------------------------
def _line(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("line")


def destination_lines(gold_destinations: DataFrame) -> DataFrame:
    return gold_destinations.select(
        "destination",
        "country",
        "total_bookings",
        "total_revenue",
        "avg_booking_value",
        _line(
            F.col("destination"), " (", F.col("country"), "): revenue ", money("total_revenue"), ", ",
            grouped_number("total_bookings"), " bookings, avg ", money("avg_booking_value"),
        ),
    )


def top_destinations(gold_destinations: DataFrame, limit: int = 5) -> DataFrame:
    """Best destinations by revenue; ties by name."""
    return destination_lines(gold_destinations.orderBy(F.desc("total_revenue"), "destination", "country").limit(limit))


def month_lines(gold_monthly: DataFrame) -> DataFrame:
    return gold_monthly.select(
        "booking_month",
        "total_bookings",
        "total_revenue",
        _line(
            F.date_format("booking_month", "yyyy-MM"), ": ", money("total_revenue"), " from ",
            grouped_number("total_bookings"), " bookings",
        ),
    )


def monthly_trend(gold_monthly: DataFrame, months: int = 6) -> DataFrame:
    """The latest months, oldest first."""
    return month_lines(gold_monthly.orderBy(F.desc("booking_month")).limit(months).orderBy("booking_month"))


def type_lines(gold_types: DataFrame) -> DataFrame:
    return gold_types.select(
        "property_type",
        "total_bookings",
        "total_revenue",
        "avg_booking_value",
        _line(
            F.col("property_type"), ": revenue ", money("total_revenue"), ", ",
            grouped_number("total_bookings"), " bookings, avg ", money("avg_booking_value"),
        ),
    )


def property_type_report(gold_types: DataFrame) -> DataFrame:
    return type_lines(gold_types.orderBy(F.desc("total_revenue"), "property_type"))


def method_lines(gold_payments: DataFrame) -> DataFrame:
    return gold_payments.select(
        "payment_method",
        "payment_count",
        "total_paid",
        _line(
            F.col("payment_method"), ": ", money("total_paid"), " across ",
            grouped_number("payment_count"), " payments",
        ),
    )


def payment_report(gold_payments: DataFrame) -> DataFrame:
    return method_lines(gold_payments.orderBy(F.desc("total_paid"), "payment_method"))


def tool_lines(
    gold_destinations: DataFrame, gold_monthly: DataFrame, gold_types: DataFrame, gold_payments: DataFrame
) -> DataFrame:
    """All lines of all tools in their order: tool, place (from 1), line.

    Money ranks as a decimal, so equal sums are ties; ties go by name.
    """
    money_first = lambda name: (-F.col(name)).cast("decimal(38,6)")
    latest_first = (-F.datediff("booking_month", F.lit("1970-01-01"))).cast("decimal(38,6)")
    no_name = F.lit(None).cast("string")
    ranked = {
        "top_destinations": (destination_lines(gold_destinations), money_first("total_revenue"), F.col("destination"), F.col("country")),
        "monthly_trend": (month_lines(gold_monthly), latest_first, no_name, no_name),
        "revenue_by_property_type": (type_lines(gold_types), money_first("total_revenue"), F.col("property_type"), no_name),
        "payment_methods": (method_lines(gold_payments), money_first("total_paid"), F.col("payment_method"), no_name),
    }
    lines = None
    for tool, (rows, first, second, third) in ranked.items():
        one = rows.select(F.lit(tool).alias("tool"), first.alias("by_1"), second.alias("by_2"), third.alias("by_3"), "line")
        lines = one if lines is None else lines.unionByName(one)
    return numbered(lines, "tool", ["by_1", "by_2", "by_3"]).select("tool", F.col("place").cast("int").alias("place"), "line")


def sized_texts(lines: DataFrame, choices: DataFrame | None = None) -> DataFrame:
    """The texts of a batch of questions: tool, rows_wanted (null: the default), tool_text.

    ``lines`` are those of tool_lines.  A text is made once for each tool and
    number of rows that the rows of ``choices`` ask for, with so many lines or
    all there are; no question has to wait for the longest text of another.
    """
    spark = lines.sparkSession
    named = spark.createDataFrame(
        [(tool, TOOL_HEADINGS[tool], rows) for tool, rows in TOOL_ROWS.items()], "tool string, heading string, rows int"
    )
    all_rows = F.lit(2**31 - 1)
    sizes = named.select("tool", "heading", F.lit(None).cast("int").alias("rows_wanted"), F.coalesce("rows", all_rows).alias("rows"))
    if choices is not None:
        asked = choices.where("rows_wanted IS NOT NULL").select("tool", "rows_wanted").distinct()
        sizes = sizes.unionByName(
            asked.join(named, "tool").select("tool", "heading", "rows_wanted", F.col("rows_wanted").alias("rows"))
        )
    sizes = materialize(sizes, "tool-sizes")
    shown = sizes.join(lines, "tool").where(F.col("place") <= F.col("rows"))
    # the trend is told oldest first
    at = F.when(F.col("tool") == "monthly_trend", -F.col("place")).otherwise(F.col("place"))
    shown = shown.withColumn("at", at).withColumn("block", F.floor(F.col("at") / BLOCK))
    texts = joined_text(shown, ["tool", "rows_wanted"], "block", ["at"], "line", "\n").select(
        F.col("tool").alias("of"), F.col("rows_wanted").alias("wanted"), "line"
    )
    same = (F.col("tool") == F.col("of")) & F.col("rows_wanted").eqNullSafe(F.col("wanted"))
    return sizes.join(texts, same, "left").select(
        "tool", "rows_wanted", F.concat("heading", F.lit("\n"), F.coalesce("line", F.lit(""))).alias("tool_text")
    )


def tool_texts(
    gold_destinations: DataFrame,
    gold_monthly: DataFrame,
    gold_types: DataFrame,
    gold_payments: DataFrame,
    limit: int = 5,
    months: int = 6,
    most: int = 0,
) -> DataFrame:
    """One row per tool (four rows): tool, heading, lines, tool_text.

    ``tool_text`` is the answer with the default number of rows.  ``lines`` are the
    report lines, best or latest first, for answers with another number of rows;
    the two limited tools hold up to ``most`` of them.
    """
    reports = {
        "top_destinations": (
            top_destinations(gold_destinations, max(limit, most)),
            F.struct(-F.col("total_revenue"), F.col("destination"), F.col("country")),
            limit,
        ),
        "monthly_trend": (
            monthly_trend(gold_monthly, max(months, most)),
            F.struct(-F.datediff("booking_month", F.lit("1970-01-01"))),
            months,
        ),
        "revenue_by_property_type": (
            property_type_report(gold_types),
            F.struct(-F.col("total_revenue"), F.col("property_type")),
            None,
        ),
        "payment_methods": (
            payment_report(gold_payments),
            F.struct(-F.col("total_paid"), F.col("payment_method")),
            None,
        ),
    }
    texts = None
    for tool, (report, place, rows) in reports.items():
        ordered = F.array_sort(F.collect_list(F.struct(place.alias("place"), F.col("line"))))
        one = report.agg(F.transform(ordered, lambda row: row["line"]).alias("lines")).select(
            F.lit(tool).alias("tool"), F.lit(TOOL_HEADINGS[tool]).alias("heading"), "lines"
        )
        one = one.withColumn("tool_text", tool_text(F.lit(rows).cast("int")))
        texts = one if texts is None else texts.unionByName(one)
    return texts


def tool_text(rows: Column) -> Column:
    """Heading and the first ``rows`` lines (all if NULL); the trend runs oldest first."""
    shown = F.slice("lines", F.lit(1), F.coalesce(rows, F.size("lines")))
    in_order = F.when(F.col("tool") == "monthly_trend", F.reverse(shown)).otherwise(shown)
    return F.concat("heading", F.lit("\n"), F.array_join(in_order, "\n"))
