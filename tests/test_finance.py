import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from goldleaf.operators import finance as N
from goldleaf.operators import table_functions as TF

LINE = (
    "VendorAccountNumber_LIFNR string, NAME1 string, CountryKey_LAND1 string, VendorOnTimeDelivery string, "
    "VendorInFullDelivery string, VendorOnTimeInFullDelivery string, VendorInvoiceAccuracy string, "
    "IsRejected string, VendorCycleTimeInDays int, NetOrderValueinTargetCurrency_NETWR decimal(18,2), "
    "TargetCurrency_TCURR string"
)


def line(vendor, otif="true", rejected="false", days=5, value="10.00", name=None):
    return (vendor, name or f"Name {vendor}", "DE", otif, "true", otif, None, rejected, days, Decimal(value), "EUR")


def test_scorecard_flags(spark):
    lines = spark.createDataFrame(
        [line("V1"), line("V1", otif="false", days=None), line("V1", otif=None, name="Zed"), line("V1", otif="TRUE"),
         line(None)],
        LINE,
    )
    (row,) = N.gold_vendor_performance(lines).collect()
    assert (row.vendor_id, row.vendor_name, row.total_po_lines) == ("V1", "Zed", 4)
    assert row.otif_rate == Decimal("0.2500")
    assert row.otif_fail_count == 1  # neither NULL nor 'TRUE' is a counted failure
    assert row.invoice_accuracy_rate == Decimal("0.0000")
    assert (row.avg_cycle_time_days, row.max_cycle_time_days) == (5.0, 5)
    assert row.total_order_value == Decimal("40.00")


def test_rate_rounds_by_way_of_five_decimals(spark):
    lines = spark.createDataFrame([line("V", otif="true" if i < 2 else "false") for i in range(3)], LINE)
    (row,) = N.gold_vendor_performance(lines).collect()
    assert row.otif_rate == Decimal("0.6667")
    assert str(N.gold_vendor_performance(lines).schema["otif_rate"].dataType) == "DecimalType(6,4)"


def vendors(spark):
    """V04 worst by OTIF; V17 has one line only; V20 has no cycle times."""
    rows = []
    for vendor, good, rejected, days in [("V04", 5, 9, 30), ("V08", 29, 1, 10), ("V12", 20, 2, 20), ("V20", 20, 3, None)]:
        rows += [
            line(vendor, otif="true" if i < good else "false", rejected="true" if i < rejected else "false", days=days)
            for i in range(30)
        ]
    rows.append(line("V17", days=1))
    rows += [line("V16", days=2)] * 29
    return N.gold_vendor_performance(spark.createDataFrame(rows, LINE))


RANKINGS = [
    ("otif", "no", ["V08", "V12", "V20", "V04"]),
    ("otif", "yes", ["V04", "V12", "V20", "V08"]),
    ("rejection", "no", ["V08", "V12", "V20", "V04"]),
    ("rejection", "yes", ["V04", "V20", "V12", "V08"]),
    ("cycle_time", "no", ["V20", "V08", "V12", "V04"]),  # NULL ranks first in both directions
    ("cycle_time", "yes", ["V20", "V04", "V12", "V08"]),
    ("on_time", "YES", ["V08", "V12", "V20", "V04"]),  # only the exact word reverses
    ("price", "yes", ["V08", "V12", "V20", "V04"]),  # unknown metric ignores the direction
]


@pytest.mark.parametrize(("metric", "worst", "order"), RANKINGS)
def test_rankings_and_sql_function(spark, metric, worst, order):
    gold = vendors(spark)
    ranked = N.rank_vendors(gold, metric, 10, worst).collect()
    assert [r.vendor_id for r in sorted(ranked, key=lambda r: r.rank_position)] == order
    TF.register_vendor_functions(gold)
    called = spark.sql(f"SELECT * FROM rank_vendors_by_metric('{metric}', 3, '{worst}') ORDER BY rank_position")
    assert [r.vendor_id for r in called.collect()] == order[:3]


def test_profiles_warn_below_thirty_lines(spark):
    gold = vendors(spark)
    spark_session = TF.register_vendor_functions(gold)
    wanted = spark.createDataFrame([("V17",), ("V16",), ("V08",), ("V99",)], "vendor_id string")
    by_join = {r.vendor_id: r.data_confidence for r in N.vendor_profiles(gold, wanted).collect()}
    by_function = {}
    for vendor in ("V17", "V16", "V08", "V99"):
        for r in spark_session.sql(f"SELECT * FROM get_vendor_performance('{vendor}')").collect():
            by_function[r.vendor_id] = r.data_confidence
    low = "LOW - too few orders, treat rates with caution"
    assert by_join == by_function == {"V17": low, "V16": low, "V08": "OK"}
    schema = {f.name: f.dataType.simpleString() for f in spark.sql("SELECT * FROM get_vendor_performance('V08')").schema}
    assert (schema["otif_rate"], schema["avg_cycle_time_days"], schema["total_order_value"]) == (
        "decimal(6,4)", "decimal(18,2)", "decimal(22,2)",
    )


CASH = "CompanyCode string, TransactionDate date, CompanyCodeCurrency string, AmountInCompanyCodeCurrency decimal(18,2)"


def cash(spark):
    day = dt.date(2024, 3, 5)
    return spark.createDataFrame(
        [
            ("1010", day, "EUR", Decimal("20.00")),
            ("1010", day, "EUR", Decimal("-3.37")),
            ("1010", day, "EUR", Decimal("0.00")),
            ("1010", day, "EUR", None),
            ("1010", dt.date(2024, 4, 1), "EUR", Decimal("1.00")),
            ("1710", day, "USD", Decimal("90.00")),
            (None, day, "EUR", Decimal("5.00")),
            ("1010", None, "EUR", Decimal("5.00")),
        ],
        CASH,
    )


def test_monthly_cashflow(spark, rows):
    gold = N.gold_monthly_cashflow(cash(spark)).withColumn("cashflow_month", F.to_date("cashflow_month"))
    march = dt.date(2024, 3, 1)
    assert sorted(rows(gold)) == [
        ("1010", march, "EUR", 4, Decimal("16.63"), Decimal("20.00"), Decimal("-3.37")),
        ("1010", dt.date(2024, 4, 1), "EUR", 1, Decimal("1.00"), Decimal("1.00"), Decimal("0.00")),
        ("1710", march, "USD", 1, Decimal("90.00"), Decimal("90.00"), Decimal("0.00")),
    ]


def test_cash_profiles_and_ranks(spark, rows):
    gold = N.gold_monthly_cashflow(cash(spark))
    assert rows(N.cashflow_profile(gold))[0][:2] == (2, 2)
    assert sorted(rows(N.cashflow_by_company(gold))) == [("1010", "EUR", 2, Decimal("18")), ("1710", "USD", 1, Decimal("90"))]
    assert [r.company_code for r in N.rank_companies(gold, 1).collect()] == ["1710"]
    assert [r.company_code for r in N.rank_companies(gold, 1, "yes").collect()] == ["1010"]
    assert rows(N.cashflow_summary(gold, "1010").select("months", "net_cashflow")) == [(2, Decimal("17.63"))]
    TF.register_cashflow_functions(gold)
    assert rows(spark.sql("SELECT company_code FROM rank_companies_by_cashflow(1, 'no')")) == [("1710",)]
    assert rows(spark.sql("SELECT months, net_cashflow FROM get_cashflow_summary('1010')")) == [(2, Decimal("17.63"))]


def test_key_overlap(spark):
    left = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "k string")
    right = spark.createDataFrame([(1,), (3,), (3,), (None,)], "j int")
    (row,) = N.key_overlap(left, "k", right, "j").collect()
    assert tuple(row) == (2, 2, 1, 2, 1, True)
    (none,) = N.key_overlap(left.filter("k = '2'"), "k", right, "j").collect()
    assert tuple(none) == (1, 2, 0, 0, 0, False)
