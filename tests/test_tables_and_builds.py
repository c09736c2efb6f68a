import datetime as dt

from pyspark.sql import functions as F

from goldleaf.plans import pipelines as B
from goldleaf.sources.tables import (
    bronze,
    conditional_update,
    layer_counts,
    materialize,
    profile_table,
    profile_tables,
    replace_table,
    save_overwrite,
    table_sample,
)
from goldleaf.sources.testbed import Testbed
from goldleaf.streaming.refresh import refresh_sales

SF_DIR = "/root/testdata/sf0.001"


def test_bronze_keeps_columns_and_adds_the_time(spark):
    df = bronze(spark.createDataFrame([(1, "a")], "k int, v string"))
    assert df.columns == ["k", "v", "_ingested_at"]
    assert df.first()._ingested_at is not None


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "`odd name` int, v string")
    assert sorted(rows(profile_table(df, "t"))) == [
        ("t", "odd name", "int", 2, 0, None), ("t", "v", "string", 2, 1, None),
    ]


def test_unreadable_table_is_an_error_row(spark):
    good = spark.range(3)
    profile = profile_tables(
        spark, {"good": lambda: good, "bad": lambda: spark.read.parquet("/nowhere/at/all"), "gone": lambda: spark.table("no_such_table")}
    ).collect()
    assert {(r.table_name, r.n_rows, r.error is None) for r in profile} == {("good", 3, True), ("bad", None, False), ("gone", None, False)}


def test_small_helpers(spark, rows):
    assert table_sample(spark.range(100)).count() == 5
    assert sorted(rows(layer_counts({"a": spark.range(3), "b": spark.range(0)}))) == [("a", 3), ("b", 0)]
    assert sorted(rows(materialize(spark.range(3), "x"))) == [(0,), (1,), (2,)]


def test_conditional_update_leaves_null_predicates_alone(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    got = rows(conditional_update(df, {"v": 9, "k": F.upper("k")}, F.col("k") == "a"))
    assert sorted(got, key=str) == sorted([("A", 9), ("b", 2), (None, 3)], key=str)


def test_replace_table_may_read_itself(spark, schema):
    name = f"{schema}.t"
    save_overwrite(spark.range(3), name)
    replace_table(spark.table(name).withColumn("id", F.col("id") + 10), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [10, 11, 12]
    assert {t.name for t in spark.catalog.listTables(schema) if not t.isTemporary} == {"t"}


def test_sales_build_retrain_and_rebuild(spark, schema, tmp_path):
    t = Testbed(spark, SF_DIR)
    for _ in range(2):  # running a build again replaces its tables
        report = B.build_sales(spark, schema, t.sales_transactions, t.sales_customers)
    assert len(report.tables) == 6
    counts = report.expectations["silver_sales_transactions"]
    stored = spark.table(f"{schema}.silver_sales_transactions").count()
    assert counts["checked_rows"] - counts["dropped_rows"] == stored
    assert counts["checked_rows"] == spark.table(f"{schema}.bronze_sales_transactions").count()

    as_of = F.lit(dt.date(2002, 1, 1))
    for run_id, configuration in (("r1", (5, 2)), ("r2", (5, 2)), ("r2", (5, 2)), ("r3", (20, 6))):  # r2 is retried
        B.retrain(spark, schema, as_of, run_id, str(tmp_path), configuration)
    log = {r.run_id: r.f1 for r in spark.table(f"{schema}.model_runs").collect()}
    champion = spark.table(f"{schema}.model_champion").collect()
    assert set(log) == {"r1", "r2", "r3"}
    assert spark.table(f"{schema}.model_runs").count() == 3
    assert log["r1"] == log["r2"]  # the same data and seed give the same model
    assert [r.run_id for r in champion] == ["r3" if log["r3"] > log["r1"] else "r1"]
    assert (tmp_path / "r2").exists()
    assert spark.table(f"{schema}.customer_features").columns[-1] == "spend_tier"


def test_travel_and_finance_builds(spark, schema):
    t = Testbed(spark, SF_DIR)
    travel = B.build_travel(spark, schema, t.bookings, t.properties, t.destinations, t.payments)
    finance = B.build_finance(spark, schema, t.cashflow, t.vendor_lines)
    assert len(travel.tables) == 9 and len(finance.tables) == 2
    silver = spark.table(f"{schema}.silver_bookings").count()
    by_month = spark.table(f"{schema}.gold_monthly_revenue").agg(F.sum("total_bookings")).first()[0]
    assert silver == by_month > 0


def test_refresh_reads_only_new_files(spark, tmp_path, rows):
    source, layers, marks = (str(tmp_path / d) for d in ("source", "layers", "marks"))

    def arrive(*sales):
        spark.createDataFrame(
            [(i, 1, "p", 1.0, price, dt.datetime(2024, 1, day)) for i, price, day in sales],
            "transactionID long, customerID long, product string, quantity double, totalPrice double, dateTime timestamp_ntz",
        ).coalesce(1).write.mode("append").parquet(source)

    arrive((1, 10.0, 1), (2, -5.0, 1))
    first = refresh_sales(spark, source, layers, marks)
    assert rows(first) == [(dt.date(2024, 1, 1), 10.0, 1, 2024, 1)]
    arrive((3, 7.0, 2), (4, 2.0, 1))
    refresh_sales(spark, source, layers, marks)
    again = refresh_sales(spark, source, layers, marks)  # nothing new: nothing changes
    assert sorted(rows(again)) == [(dt.date(2024, 1, 1), 12.0, 2, 2024, 1), (dt.date(2024, 1, 2), 7.0, 1, 2024, 1)]
    raw = spark.read.parquet(f"{layers}/bronze_sales_transactions")
    assert raw.count() == 4 and raw.filter("_ingested_at IS NULL").count() == 0
