"""One key with a third (or more) of all rows: same results, spread work."""

import pytest
from pyspark.sql import functions as F

from goldleaf.operators import planner as L
from goldleaf.operators import travel as V
from goldleaf.operators.skew import lookup_join


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_join_equals_left_join_and_spreads_the_hot_key(no_broadcast):
    spark = no_broadcast
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
    )
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k7", 3), ("unused", 4)], "key string, v int")
    got = lookup_join(facts, lookup, "key", spread_by="id")
    plain = facts.join(lookup, "key", "left")
    assert got.columns == plain.columns
    assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)


@pytest.mark.parametrize("hot, nulls", [(0.34, 0.0), (0.01, 0.98), (0.5, 0.3)])
def test_no_task_of_the_lookup_join_has_much_more_than_the_mean(no_broadcast, hot, nulls):
    """Rows per task behind the join, without broadcasts of tables and without adaptive execution."""
    spark = no_broadcast
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        facts = spark.range(0, n, numPartitions=8).select(
            "id",
            F.when(F.col("id") < hot * n, "hot").when(F.col("id") >= (hot + nulls) * n, F.concat(F.lit("k"), F.col("id") % 5000)).alias("key"),
        )
        lookup = spark.range(5000).selectExpr("concat('k', id) AS key", "id AS v").union(spark.createDataFrame([("hot", 1)], "key string, v long"))
        joined = lookup_join(facts, lookup, "key", spread_by="id")
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == n
        # NULL keys stay in the 8 input tasks; no task behind the shuffle gets more than one of those has.
        assert max(per_task) <= n / 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_request_text_is_resolved_once(no_broadcast):
    spark = no_broadcast
    places = spark.createDataFrame(
        [(1, "Paris", "France"), (2, "Rome", "Italy")], "destination_id long, destination string, country string"
    )
    requests = spark.range(2000).select(
        F.col("id").alias("request_id"),
        F.when(F.col("id") % 2 == 0, "to rome please").when(F.col("id") % 5 == 0, "Paris").otherwise(F.concat(F.lit("zz"), "id")).alias("destination_text"),
    )
    got = L.resolve_destination(requests, places)
    counts = {(r.status, r.destination_id): r["count"] for r in got.groupBy("status", "destination_id").count().collect()}
    assert counts == {("city", 2): 1000, ("city", 1): 200, ("unknown", None): 800}


def test_payments_of_a_hot_booking(no_broadcast):
    spark = no_broadcast
    payments = spark.range(3000).select(
        F.when(F.col("id") % 3 != 2, 1).otherwise(F.col("id")).alias("booking_id"),
        F.concat(F.lit("m"), F.col("id") % 2).alias("payment_method"),
        F.lit(1.0).alias("amount"),
        F.lit("completed").alias("status"),
    )
    silver = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("booking_id"))
    plain = (
        payments.join(silver, "booking_id").groupBy("payment_method").agg(F.count(F.lit(1)), F.round(F.sum("amount"), 2))
    )
    assert sorted(map(tuple, V.gold_payment_methods(payments, silver).collect())) == sorted(map(tuple, plain.collect()))


def test_adaptive_execution_can_split_the_booking_join(no_broadcast):
    """Both inputs of the booking join are plain exchanges, so a hot property is split."""
    spark = no_broadcast
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        bookings = spark.range(0, 60000, numPartitions=8).selectExpr(
            "id AS booking_id", "IF(id % 3 = 0, 7, id % 500) AS property_id", "date'2024-01-01' AS check_in",
            "date'2024-01-03' AS check_out", "1 AS guests_count", "double(id + 1) AS total_amount", "'ok' AS status",
        )
        properties = spark.range(500).selectExpr("id AS property_id", "id % 5 AS destination_id", "'t' AS title", "'x' AS property_type")
        places = spark.range(5).selectExpr("id AS destination_id", "'d' AS destination", "'c' AS country", "'s' AS state_or_province")
        silver = V.silver_bookings(bookings, properties, places)
        assert len(silver.collect()) == 60000
        plan = silver._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
