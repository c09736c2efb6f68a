"""What the physical plans must and must not contain."""

import pytest

from goldleaf.operators import planner as L
from goldleaf.operators import travel as V
from goldleaf.plans.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
FITS = {"spend_tier_model", "batch_score", "retrain_runs"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - FITS))
def test_no_cross_join_and_no_python(no_broadcast, name):
    plan = plan_of(REGISTRY[name](no_broadcast, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "MapInArrow"):
        assert node not in plan


@pytest.mark.parametrize("name", ["rank_vendors_otif_worst", "rank_vendors_function", "top_destinations"])
def test_top_k_is_cut_before_it_is_gathered(spark, name):
    assert "TakeOrderedAndProject" in plan_of(REGISTRY[name](spark, SF_DIR))


def test_cheapest_properties_are_cut_on_the_map_side(spark):
    properties = spark.range(100).selectExpr(
        "id AS property_id", "id % 3 AS destination_id", "'t' AS title", "'x' AS property_type",
        "double(id) AS base_price", "1 AS bedrooms", "2 AS max_guests",
    )
    plan = plan_of(L.cheapest_properties(properties))
    assert plan.count("WindowGroupLimit") == 2


def test_booking_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bookings")
    spark.range(10).selectExpr(
        "id AS booking_id", "id AS property_id", "date'2024-01-01' AS check_in", "date'2024-01-03' AS check_out",
        "1 AS guests_count", "double(id) AS total_amount", "'ok' AS status", "'x' AS unused",
    ).write.parquet(path)
    properties = spark.range(10).selectExpr(
        "id AS property_id", "id AS destination_id", "'t' AS title", "'x' AS property_type"
    )
    places = spark.range(10).selectExpr(
        "id AS destination_id", "'d' AS destination", "'c' AS country", "'s' AS state_or_province"
    )
    gold = V.gold_monthly_revenue(V.silver_bookings(spark.read.parquet(path), properties, places))
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = gold._jdf.queryExecution().explainString(formatted)
    assert "GreaterThan(total_amount,0.0)" in plan
    assert "unused" not in plan
    assert "guests_count" not in plan
