import datetime as dt

from pyspark.sql import functions as F

from goldleaf.operators import dashboards as D
from goldleaf.operators import travel as V

DAY = dt.date


def bookings(spark):
    return spark.createDataFrame(
        [
            (1, 100, DAY(2024, 1, 30), DAY(2024, 2, 2), 2, 300.0, "ok"),
            (1, 100, DAY(2024, 1, 30), DAY(2024, 2, 2), 2, 300.0, "ok"),  # repeated booking row
            (2, 101, DAY(2024, 2, 1), DAY(2024, 2, 1), 2, 300.0, "ok"),  # no night
            (3, 101, DAY(2024, 2, 1), DAY(2024, 2, 4), 2, 0.0, "ok"),  # no amount
            (4, 101, DAY(2024, 2, 1), None, 2, 50.0, "ok"),
            (5, 999, DAY(2024, 2, 1), DAY(2024, 2, 4), 2, 50.0, "ok"),  # unknown property
            (6, 101, DAY(2024, 2, 1), DAY(2024, 2, 2), 1, 100.0, "ok"),
        ],
        "booking_id long, property_id long, check_in date, check_out date, guests_count int, "
        "total_amount double, status string",
    )


def properties(spark):
    return spark.createDataFrame(
        [(100, 1, "Loft", "apartment", 80.0), (101, 2, "Hut", "house", None), (102, 2, "Barn", "house", 25.5)],
        "property_id long, destination_id long, title string, property_type string, base_price double",
    )


def destinations(spark):
    return spark.createDataFrame(
        [(1, "Paris", "France", "IDF"), (2, "Rome", "Italy", None), (3, "Oslo", "Norway", None)],
        "destination_id long, destination string, country string, state_or_province string",
    )


def silver(spark):
    return V.silver_bookings(bookings(spark), properties(spark), destinations(spark))


def test_silver_bookings(spark, rows):
    got = sorted(rows(silver(spark).select("booking_id", "destination", "nights", F.to_date("booking_month"))))
    assert got == [(1, "Paris", 3, DAY(2024, 1, 1))] * 2 + [(6, "Rome", 1, DAY(2024, 2, 1))]


def test_lost_rows_by_cause(spark, rows):
    counts = dict(rows(V.travel_layer_counts(bookings(spark), properties(spark), destinations(spark))))
    assert counts == {"bronze_bookings": 7, "lost_invalid": 3, "lost_unmatched": 1, "silver_bookings": 3}


def test_payments_count_once_per_booking_row(spark, rows):
    payments = spark.createDataFrame(
        [(1, "card", 10.0, "completed"), (1, "card", 5.0, "completed"), (6, "cash", 1.0, "completed"),
         (6, "cash", 9.0, "pending"), (5, "card", 7.0, "completed"), (None, "card", 7.0, "completed")],
        "booking_id long, payment_method string, amount double, status string",
    )
    assert sorted(rows(V.gold_payment_methods(payments, silver(spark)))) == [("card", 4, 30.0), ("cash", 1, 1.0)]


def test_price_stats_keep_empty_destinations(spark, rows):
    got = {r[0]: r[2:] for r in rows(V.destination_price_stats(destinations(spark), properties(spark)))}
    assert got == {
        "Paris": (1, 80.0, 80.0, 80.0),
        "Rome": (2, 26.0, 26.0, 26.0),  # the NULL price counts as a property, not as a price
        "Oslo": (0, None, None, None),
    }


def test_names_per_country_are_sorted(spark, rows):
    more = destinations(spark).union(spark.createDataFrame([(4, "Aix", "France", None)], destinations(spark).schema))
    assert ("France", 2, "Aix, Paris") in rows(V.destinations_per_country(more))


def test_chart_cuts_before_it_sums(spark, rows):
    gold = spark.createDataFrame(
        [("A", "x", 10.0), ("A", "y", 9.0), ("B", "x", 8.0)],
        "destination string, country string, total_revenue double",
    )
    assert rows(D.top_destinations_chart(gold, 2)) == [("A", 19.0)]
    assert sorted(rows(D.top_destinations_chart(gold, 1))) == [("A", 10.0)]


def test_gaps_become_zero(spark, rows):
    daily = spark.createDataFrame(
        [(DAY(2024, 1, 1), 5.0, 2), (DAY(2024, 1, 3), 1.0, 1)],
        "transaction_date date, daily_revenue double, transaction_count long",
    )
    assert sorted(rows(D.daily_revenue_chart(daily, fill_gaps=True))) == [
        (DAY(2024, 1, 1), 5.0, 2), (DAY(2024, 1, 2), 0.0, 0), (DAY(2024, 1, 3), 1.0, 1),
    ]
    assert D.daily_revenue_chart(daily).count() == 2
    assert D.daily_revenue_chart(daily.limit(0), fill_gaps=True).count() == 0


def test_trend_is_latest_and_oldest_first(spark):
    gold = spark.createDataFrame(
        [(dt.datetime(2024, m, 1), 1000 * m, 1234.5 + m) for m in range(1, 9)],
        "booking_month timestamp, total_bookings long, total_revenue double",
    )
    lines = [r.line for r in D.monthly_trend(gold, 2).collect()]
    assert lines == ["2024-07: $1,242 from 7,000 bookings", "2024-08: $1,242 from 8,000 bookings"]


def test_tool_texts(spark):
    s = silver(spark)
    payments = spark.createDataFrame(
        [(1, "card", 1500.0, "completed")], "booking_id long, payment_method string, amount double, status string"
    )
    texts = {
        r.tool: r.tool_text
        for r in D.tool_texts(
            V.gold_revenue_by_destination(s), V.gold_monthly_revenue(s), V.gold_revenue_by_property_type(s),
            V.gold_payment_methods(payments, s),
        ).collect()
    }
    assert texts["top_destinations"] == (
        "Top destinations by revenue:\nParis (France): revenue $600, 2 bookings, avg $300\n"
        "Rome (Italy): revenue $100, 1 bookings, avg $100"
    )
    assert texts["payment_methods"] == "Payment methods (completed payments):\ncard: $3,000 across 2 payments"
    assert texts["monthly_trend"].splitlines()[1:] == ["2024-01: $600 from 2 bookings", "2024-02: $100 from 1 bookings"]
