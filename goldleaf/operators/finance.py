"""Finance gold: vendor scorecard, monthly cash flow, profiles, summaries, ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.functions.numbers import share
from goldleaf.functions.phrases import ENOUGH_EVIDENCE, LOW_EVIDENCE, MIN_EVIDENCE_LINES


FLAGS = {
    "on_time_rate": "VendorOnTimeDelivery",
    "in_full_rate": "VendorInFullDelivery",
    "otif_rate": "VendorOnTimeInFullDelivery",
    "invoice_accuracy_rate": "VendorInvoiceAccuracy",
    "rejection_rate": "IsRejected",
}


def gold_vendor_performance(lines: DataFrame) -> DataFrame:
    """One scorecard row per vendor.

    A rate counts flags that are exactly 'true' among all lines, so a flag that
    is neither 'true' nor 'false' lowers the rate but is no counted failure; the
    failure count is not ``1 - rate``.

    The lines are first summed per vendor and its text attributes.  Those sums
    are numbers, so they run as a hash aggregate with a map-side combine; taking
    the greatest text straight from the lines would sort all of them.
    """
    days, value = F.col("VendorCycleTimeInDays"), F.col("NetOrderValueinTargetCurrency_NETWR")
    summed = (
        lines.filter(F.col("VendorAccountNumber_LIFNR").isNotNull())
        .groupBy(
            F.col("VendorAccountNumber_LIFNR").alias("vendor_id"),
            F.col("NAME1").alias("vendor_name"),
            F.col("CountryKey_LAND1").alias("country"),
            F.col("TargetCurrency_TCURR").alias("currency"),
        )
        .agg(
            F.count(F.lit(1)).alias("lines"),
            *[F.count_if(F.col(flag) == "true").alias(name) for name, flag in FLAGS.items()],
            F.sum(days).alias("days"),
            F.count(days).alias("timed"),
            F.max(days).alias("longest"),
            F.count_if(F.col("VendorOnTimeInFullDelivery") == "false").alias("failed"),
            F.sum(value).alias("value"),
        )
    )
    lines_total = F.sum("lines")
    return summed.groupBy("vendor_id").agg(
        F.max("vendor_name").alias("vendor_name"),
        F.max("country").alias("country"),
        lines_total.alias("total_po_lines"),
        *[share(F.sum(name), lines_total).alias(name) for name in FLAGS],
        F.round(F.try_divide(F.sum("days"), F.sum("timed")), 2).alias("avg_cycle_time_days"),
        F.max("longest").alias("max_cycle_time_days"),
        F.sum("failed").alias("otif_fail_count"),
        F.round(F.sum("value"), 2).alias("total_order_value"),
        F.max("currency").alias("currency"),
    )


def evidence(lines: Column | str = "total_po_lines") -> Column:
    """Warning for vendors whose rates rest on few lines."""
    column = F.col(lines) if isinstance(lines, str) else lines
    return F.when(column < MIN_EVIDENCE_LINES, LOW_EVIDENCE).otherwise(ENOUGH_EVIDENCE)


def vendor_profiles(gold: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Profiles of the vendors in ``wanted`` (column vendor_id), or of all vendors."""
    profile = gold.select(
        "vendor_id",
        "vendor_name",
        "country",
        "total_po_lines",
        "otif_rate",
        "on_time_rate",
        "in_full_rate",
        "rejection_rate",
        "avg_cycle_time_days",
        "total_order_value",
        "currency",
        evidence().alias("data_confidence"),
    )
    return profile if wanted is None else wanted.select("vendor_id").join(profile, "vendor_id")


# metric -> (column, is a low value good)
METRICS = {
    "otif": ("otif_rate", False),
    "on_time": ("on_time_rate", False),
    "rejection": ("rejection_rate", True),
    "cycle_time": ("avg_cycle_time_days", True),
}


def rank_vendors(gold: DataFrame, metric: str, top_n: int, worst_first: str = "no") -> DataFrame:
    """Best or worst vendors by a metric, among those with enough lines.

    An unknown metric ranks by OTIF, best first, whatever the direction.  NULL
    metrics rank first and vendor_id breaks ties.  The rows are cut to top_n
    before they are numbered: each task keeps its own top_n and only those meet.
    """
    column, low_is_good = METRICS.get(metric, METRICS["otif"])
    reverse = worst_first == "yes" and metric in METRICS
    ascending = low_is_good != reverse
    key = F.col(column).asc_nulls_first() if ascending else F.col(column).desc_nulls_first()
    order = [key, F.col("vendor_id").asc()]
    return (
        gold.filter(F.col("total_po_lines") >= MIN_EVIDENCE_LINES)
        .orderBy(*order)
        .limit(top_n)
        .select(
            F.row_number().over(Window.orderBy(*order)).alias("rank_position"),
            "vendor_id",
            "vendor_name",
            "total_po_lines",
            "otif_rate",
            "on_time_rate",
            "rejection_rate",
            "avg_cycle_time_days",
        )
    )


def gold_monthly_cashflow(cashflow: DataFrame) -> DataFrame:
    """Inflow is the sum of positives, outflow the (negative) sum of negatives."""
    amount = F.col("AmountInCompanyCodeCurrency")
    return (
        cashflow.filter(F.col("TransactionDate").isNotNull() & F.col("CompanyCode").isNotNull())
        .groupBy(
            F.col("CompanyCode").alias("company_code"),
            F.date_trunc("month", "TransactionDate").alias("cashflow_month"),
            F.col("CompanyCodeCurrency").alias("currency"),
        )
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum(amount).alias("net_cashflow"),
            F.sum(F.when(amount > 0, amount).otherwise(0)).alias("total_inflow"),
            F.sum(F.when(amount < 0, amount).otherwise(0)).alias("total_outflow"),
        )
    )


def cashflow_profile(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count_distinct("company_code").alias("n_company_codes"),
        F.count_distinct("currency").alias("n_currencies"),
        F.min("cashflow_month").alias("earliest_month"),
        F.max("cashflow_month").alias("latest_month"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def cashflow_by_company(gold: DataFrame) -> DataFrame:
    return gold.groupBy("company_code", "currency").agg(
        F.count(F.lit(1)).alias("months"), F.round(F.sum("net_cashflow"), 0).alias("total_net")
    )


def cashflow_summary(gold: DataFrame, company_code: str | None = None) -> DataFrame:
    """Totals per company and currency over all months, or for one company."""
    rows = gold if company_code is None else gold.filter(F.col("company_code") == company_code)
    return rows.groupBy("company_code", "currency").agg(
        F.count(F.lit(1)).alias("months"),
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("total_inflow").alias("total_inflow"),
        F.sum("total_outflow").alias("total_outflow"),
        F.sum("net_cashflow").alias("net_cashflow"),
    )


def rank_companies(gold: DataFrame, top_n: int = 5, lowest_first: str = "no") -> DataFrame:
    """Companies by total net cash flow, cut before numbering as in rank_vendors."""
    net = F.col("net_cashflow")
    order = [
        net.asc_nulls_first() if lowest_first == "yes" else net.desc_nulls_first(),
        F.col("company_code"),
        F.col("currency"),
    ]
    return (
        cashflow_summary(gold)
        .orderBy(*order)
        .limit(top_n)
        .select(
            F.row_number().over(Window.orderBy(*order)).alias("rank_position"),
            "company_code",
            "currency",
            "months",
            "net_cashflow",
        )
    )


def key_overlap(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """How many distinct keys two tables share, and how many rows those keys cover.

    Keys of both sides are counted in one grouping, so a key with a third of all
    rows is combined on the map side and no join is needed.
    """
    one, other = left.schema[left_key].dataType, right.schema[right_key].dataType
    # keys of different types are compared as text
    as_key = [F.col(k) if one == other else F.col(k).cast("string") for k in (left_key, right_key)]
    tagged = left.select(as_key[0].alias("key"), F.lit(True).alias("is_left")).unionByName(
        right.select(as_key[1].alias("key"), F.lit(False).alias("is_left"))
    )
    per_key = (
        tagged.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count_if("is_left").alias("l"), F.count_if(~F.col("is_left")).alias("r"))
    )
    in_left, in_right = F.col("l") > 0, F.col("r") > 0
    return per_key.agg(
        F.count_if(in_left).alias("left_keys"),
        F.count_if(in_right).alias("right_keys"),
        F.count_if(in_left & in_right).alias("shared_keys"),
        F.coalesce(F.sum(F.when(in_right, F.col("l"))), F.lit(0)).alias("left_rows_matched"),
        F.coalesce(F.sum(F.when(in_left, F.col("r"))), F.lit(0)).alias("right_rows_matched"),
    ).withColumn("joinable", F.col("shared_keys") > 0)
