import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from goldleaf.sources.stored import PartitionedTable, exists
from goldleaf.sources.tables import record_rows
from goldleaf.streaming.refresh import SALES, SalesLayers


def table(spark, tmp_path, n_runs=3):
    t = PartitionedTable(spark, str(tmp_path / "t"), "k int, v string, run_id string", ["run_id"])
    t.replace(spark.createDataFrame([(i, "a", f"{r:03d}") for r in range(n_runs) for i in range(4)], t.schema))
    return t


def files(path, key="run_id"):
    """Names of the data files by value of the key."""
    found = {}
    for file in Path(path).rglob("part-*.parquet"):
        value = next(p.split("=")[1] for p in file.parts if p.startswith(f"{key}="))
        found.setdefault(value, set()).add(file.name)
    return found


def test_absent_table_is_empty(spark, tmp_path):
    t = PartitionedTable(spark, str(tmp_path / "none"), "k int, run_id string", ["run_id"])
    assert t.read().count() == 0 and t.update("s", {"k": 1}, F.lit(True)) == []


def test_a_retried_run_replaces_its_own_partition_only(spark, tmp_path, rows):
    t = table(spark, tmp_path)
    before = files(t.path)
    t.replace(spark.createDataFrame([(9, "b", "001")], t.schema))
    after = files(t.path)
    assert after["000"] == before["000"] and after["002"] == before["002"] and after["001"] != before["001"]
    assert rows(t.read().where("run_id = '001'")) == [(9, "b", "001")]
    assert t.read().schema["run_id"].dataType.simpleString() == "string"


def test_update_rewrites_touched_partitions_only(spark, tmp_path, rows):
    t = table(spark, tmp_path)
    t.replace(spark.createDataFrame([(None, None, None), (7, "x", None)], t.schema))
    before = files(t.path)
    assert t.update("s1", {"v": F.upper("v")}, (F.col("k") == 2) & (F.col("run_id") == "001")) == [("001",)]
    after = files(t.path)
    assert {r for r in after if after[r] != before[r]} == {"001"}
    assert sorted(rows(t.read().where("run_id = '001'"))) == [(0, "a", "001"), (1, "a", "001"), (2, "A", "001"), (3, "a", "001")]
    # a null key is a partition like another; a null predicate touches nothing
    assert t.update("s2", {"v": "y"}, F.col("k") == 7) == [(None,)]
    assert sorted(rows(t.read().where("run_id IS NULL")), key=str) == [(7, "y", None), (None, None, None)]
    assert t.update("s3", {"v": "z"}, F.col("v") == "nowhere") == []
    assert t.read().count() == 14


def test_update_reads_touched_partitions_only(spark, tmp_path):
    t = table(spark, tmp_path)
    plan = t.read().where(t.within([("001",)]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(run_id" in plan and "001" in plan


def test_keys_stay(spark, tmp_path):
    with pytest.raises(ValueError, match="run_id"):
        table(spark, tmp_path).update("s", {"run_id": "x"}, F.lit(True))


def test_a_repeated_step_takes_the_rows_it_made(spark, tmp_path, rows):
    """As after a failure between making the rows and the end of the replacement."""
    t = table(spark, tmp_path)
    add = lambda: t.read().where("run_id = '001'").withColumn("k", F.col("k") + 10)
    t.apply("one", add)
    t.apply("one", add)
    assert sorted(r.k for r in t.read().where("run_id = '001'").collect()) == [10, 11, 12, 13]
    t.apply("two", add)
    assert sorted(r.k for r in t.read().where("run_id = '001'").collect()) == [20, 21, 22, 23]
    assert not exists(spark, f"{t.path}__pending/one") and exists(spark, f"{t.path}__pending/two")


def test_record_rows_leaves_other_runs_alone(spark, schema, rows):
    name = f"{schema}.history"

    def record(run, *values):
        record_rows(spark.createDataFrame([(run, v) for v in values], "run_id string, v int"), name, "run_id")

    record("007", 1, 2)
    record("008", 3)
    folder = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    kept = files(folder)
    record("008", 4)
    assert sorted(rows(spark.table(name))) == [(1, "007"), (2, "007"), (4, "008")]
    assert files(folder)["007"] == kept["007"] and files(folder)["008"] != kept["008"]


def sale(i, price, month, day=1):
    return (i, 1, "p", 1.0, price, dt.datetime(2024, month, day))


def daily(layers):
    return sorted((r.transaction_date.isoformat(), r.daily_revenue, r.transaction_count) for r in layers.daily.read().collect())


def test_repeated_batches_are_added_once_and_other_months_stay(spark, tmp_path):
    layers = SalesLayers(spark, str(tmp_path))
    first = spark.createDataFrame([sale(1, 10.0, 1), sale(2, -5.0, 1), sale(3, 4.0, 2)], SALES)
    second = spark.createDataFrame([sale(4, 1.0, 2), sale(5, 2.0, 2, 9)], SALES)
    layers.load(first, 0)
    january = files(layers.daily.path, "month")["1"]
    for _ in range(2):
        layers.load(second, 1)
        assert daily(layers) == [("2024-01-01", 10.0, 1), ("2024-02-01", 5.0, 2), ("2024-02-09", 2.0, 1)]
    assert january == files(layers.daily.path, "month")["1"]
    assert spark.read.parquet(layers.bronze_path).count() == 5 and spark.read.parquet(layers.silver_path).count() == 4


def test_failure_half_way_through_a_batch(spark, tmp_path, monkeypatch):
    layers = SalesLayers(spark, str(tmp_path))
    layers.load(spark.createDataFrame([sale(1, 10.0, 1)], SALES), 0)
    batch = spark.createDataFrame([sale(2, 3.0, 1), sale(3, 4.0, 2)], SALES)
    whole = layers.daily.replace

    def half(rows):
        whole(rows.where("month = 1"))
        raise RuntimeError("lost")

    monkeypatch.setattr(layers.daily, "replace", half)
    with pytest.raises(RuntimeError):
        layers.load(batch, 1)
    monkeypatch.setattr(layers.daily, "replace", whole)
    layers.load(batch, 1)
    assert daily(layers) == [("2024-01-01", 13.0, 2), ("2024-02-01", 4.0, 1)]


def test_an_empty_batch_and_one_without_valid_rows(spark, tmp_path):
    layers = SalesLayers(spark, str(tmp_path))
    layers.load(spark.createDataFrame([], SALES), 0)
    layers.load(spark.createDataFrame([sale(1, -1.0, 1)], SALES), 1)
    assert daily(layers) == []
    layers.load(spark.createDataFrame([sale(1, 1.0, 1)], SALES), 2)
    assert daily(layers) == [("2024-01-01", 1.0, 1)]


def test_totals_per_customer_follow_batches_and_moves(spark, tmp_path):
    layers = SalesLayers(spark, str(tmp_path), buckets=4)
    layers.load(spark.createDataFrame([sale(1, 10.0, 1), (2, None, "p", 1.0, 9.0, dt.datetime(2024, 1, 1))], SALES), 0)
    second = spark.createDataFrame([(3, 1, "p", 1.0, 5.0, dt.datetime(2024, 1, 1)), (4, 2, "p", 1.0, 7.0, dt.datetime(2024, 1, 1))], SALES)
    for _ in range(2):
        layers.load(second, 1)
    customers = [(1, "Ohio"), (2, "Utah"), (3, "Iowa")]
    states = lambda rows: sorted(map(tuple, layers.revenue_by_state(spark.createDataFrame(rows, "customerID long, state string")).collect()))
    assert states(customers) == [("Ohio", 15.0, 2), ("Utah", 7.0, 1)]
    assert states([(1, "Utah"), (2, "Utah")]) == [("Utah", 22.0, 3)]
