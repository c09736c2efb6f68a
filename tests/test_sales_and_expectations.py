import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from goldleaf.operators import sales as S
from goldleaf.operators.expectations import apply_expectations, expectation_counts, observed_expectations

RAW = "transactionID long, customerID long, product string, quantity string, totalPrice string, dateTime string"


def raw_sales(spark):
    return spark.createDataFrame(
        [
            (1, 10, "a", "2", "20.5", "2024-05-01"),
            (2, 10, "a", "0.5", "20.5", "2024-05-01"),  # 0.5 becomes 0
            (3, 10, "a", "2", "0", "2024-05-01"),  # boundary: zero is not positive
            (4, 11, "b", "2", "5", None),
            (5, 11, "b", "many", "5", "2024-05-02"),  # no number: NULL, dropped, counted
            (6, 12, "b", None, "-1", "soon"),  # fails all three
            (None, 12, "c", "1", "7", "2024-05-02"),
        ],
        RAW,
    )


def test_silver_drops_and_types(spark, rows):
    got = sorted(rows(S.silver_sales(raw_sales(spark))), key=str)
    assert got == sorted(
        [(1, 10, "a", 2, 20.5, dt.date(2024, 5, 1)), (None, 12, "c", 1, 7.0, dt.date(2024, 5, 2))], key=str
    )


def test_counts_per_constraint(spark, rows):
    counts = expectation_counts(S.typed_sales(raw_sales(spark)), S.sales_constraints(), "sales")
    assert sorted(rows(counts)) == [
        ("sales", "has_transaction_date", 2, 5, 7),
        ("sales", "valid_amount", 2, 5, 7),
        ("sales", "valid_quantity", 3, 5, 7),
    ]


def test_counts_of_empty_input(spark, rows):
    empty = S.typed_sales(raw_sales(spark)).limit(0)
    assert {r[2:] for r in rows(expectation_counts(empty, S.sales_constraints(), "x"))} == {(0, 0, 0)}


def test_observed_counts_come_with_the_write(spark):
    seen = Observation("seen")
    typed = S.typed_sales(raw_sales(spark))
    assert observed_expectations(typed, S.sales_constraints(), seen).count() == 2
    assert seen.get == {
        "checked_rows": 7, "dropped_rows": 5, "valid_quantity": 3, "valid_amount": 2, "has_transaction_date": 2,
    }


def test_null_condition_fails(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    assert apply_expectations(df, {"positive": F.col("v") > 0}).count() == 1


def test_daily_revenue_counts_non_null_ids(spark, rows):
    silver = S.silver_sales(raw_sales(spark))
    assert sorted(rows(S.gold_daily_revenue(silver))) == [
        (dt.date(2024, 5, 1), 20.5, 1, 2024, 5),
        (dt.date(2024, 5, 2), 7.0, 0, 2024, 5),
    ]


def test_revenue_by_state_equals_plain_join(spark, rows):
    sales = spark.createDataFrame(
        [(i, i % 4 if i % 5 else 0, float(i)) for i in range(60)] + [(99, None, 1.0), (None, 1, 2.0)],
        "transactionID long, customerID long, total_price double",
    )
    customers = spark.createDataFrame(
        [(0, "CA"), (0, "CA"), (1, "NY"), (2, None), (2, "CA"), (7, "TX")], "customerID long, state string"
    )
    plain = (
        sales.join(customers, "customerID")
        .groupBy("state")
        .agg(F.sum("total_price"), F.count("transactionID"))
    )
    assert sorted(rows(S.gold_revenue_by_state(sales, customers)), key=str) == sorted(rows(plain), key=str)
