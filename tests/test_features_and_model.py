import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from goldleaf.operators import features as X
from goldleaf.operators import modelling as M


def test_customer_features(spark, rows):
    silver = spark.createDataFrame(
        [(1, 7, "a", 10.0, dt.date(2024, 1, 1)), (2, 7, "a", 5.0, dt.date(2024, 1, 5)), (None, 7, "b", 1.0, dt.date(2024, 1, 2))],
        "transactionID long, customerID long, product string, total_price double, transaction_date date",
    )
    assert rows(X.customer_features(silver, F.lit(dt.date(2024, 1, 15)))) == [(7, 16.0, 2, 2, 10)]


@pytest.mark.parametrize("values", [
    [5.0],
    [1.0] * 50,
    [float(i) for i in range(1000)],
    [1.0] * 700 + [float(i) for i in range(300)],  # one value with most of the rows
    [3.0, 1.0, 2.0, None],
    [round(random.Random(1).gauss(100, 30), 2) for _ in range(5000)],
])
def test_exact_cuts_match_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "total_spend double").repartition(7)
    ordered = sorted(v for v in values if v is not None)
    wanted = tuple(ordered[max(math.ceil(p * len(ordered)), 1) - 1] for p in X.TIER_CUTS)
    # a coarse sketch makes wide brackets, a fine one narrow ones; the cuts are the same
    assert tuple(X.exact_cuts(df).first()) == wanted
    assert tuple(X.exact_cuts(df, ranges=3).first()) == wanted


def test_approximate_cuts_are_within_one_percent(spark):
    df = spark.range(0, 10_000, numPartitions=13).select(F.col("id").cast("double").alias("total_spend"))
    low, high = X.approximate_cuts(df).first()
    assert abs(low - 3300) <= 100 and abs(high - 6600) <= 100


def test_tiers_at_the_cuts(spark, rows):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "total_spend double")
    tiers = {r.total_spend: r.spend_tier for r in X.with_spend_tier(df, X.exact_cuts(df)).collect()}
    assert (tiers[33.0], tiers[34.0], tiers[66.0], tiers[67.0]) == (0, 1, 1, 2)


def test_split_is_exact_per_label_and_stable(spark):
    data = [(i, 0 if i % 3 else 1) for i in range(1000)] + [(5000, 2), (5001, None)]
    schema = "customerID long, spend_tier int"
    one = X.stratified_split(spark.createDataFrame(data, schema).repartition(5), "spend_tier", "customerID")
    random.Random(2).shuffle(data)
    # a one-digit prefix makes large ranges, four digits small ones; the split is the same
    two = X.stratified_split(spark.createDataFrame(data, schema).repartition(2), "spend_tier", "customerID", digits=1)
    first = {r.customerID: r.split for r in one.collect()}
    assert first == {r.customerID: r.split for r in two.collect()}
    for label in (0, 1, 2, None):
        ids = [i for i, t in data if t == label]
        assert sum(first[i] == "test" for i in ids) == math.ceil(len(ids) * 0.25)
    other = X.stratified_split(spark.createDataFrame(data, schema), "spend_tier", "customerID", seed=7)
    assert first != {r.customerID: r.split for r in other.collect()}


def python_metrics(pairs):
    classes = {a for a, _ in pairs} | {b for _, b in pairs}
    f1 = 0.0
    for c in classes:
        hits = sum(a == b == c for a, b in pairs)
        support, called = sum(a == c for a, _ in pairs), sum(b == c for _, b in pairs)
        f1 += support * (2 * hits / (support + called)) / len(pairs)
    return len(pairs), sum(a == b for a, b in pairs) / len(pairs), f1


def test_metrics_match_python_and_the_ml_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(6)
    pairs = [(rng.choice([0, 0, 1, 2]), rng.choice([0, 1, 1])) for _ in range(500)]
    df = spark.createDataFrame(pairs, "label int, predicted int")
    n, accuracy, f1 = M.classification_metrics(df, "label", "predicted").first()
    assert (n, accuracy, f1) == pytest.approx(python_metrics(pairs))
    as_double = df.select(F.col("label").cast("double"), F.col("predicted").cast("double").alias("prediction"))
    for metric, value in (("accuracy", accuracy), ("f1", f1)):
        assert MulticlassClassificationEvaluator(metricName=metric).evaluate(as_double) == pytest.approx(value)


def runs(spark, rows):
    return spark.createDataFrame(rows, "run_id string, f1 double")


def test_best_run_and_promotion(spark, rows):
    log = runs(spark, [("b", 0.8), ("a", 0.8), ("c", None)])
    assert rows(M.best_run(log)) == [("a", 0.8)]
    gate = {r.run_id: r.promote for r in M.promotion_gate(log, runs(spark, [("old", 0.8)])).collect()}
    assert gate == {"a": False, "b": False, "c": False}  # equal is not better
    gate = {r.run_id: r.promote for r in M.promotion_gate(log, runs(spark, [("old", 0.7)])).collect()}
    assert gate == {"a": True, "b": True, "c": False}
    gate = {r.run_id: r.promote for r in M.promotion_gate(log, log.limit(0)).collect()}
    assert gate == {"a": True, "b": True, "c": False}


def test_model_is_the_same_for_any_partitioning(spark):
    rng = random.Random(3)
    data = []
    for i in range(300):
        tier = i % 3
        data.append((i, 10 * tier + rng.randint(0, 4), 5 * tier + rng.randint(0, 2), 300 - 90 * tier, tier))
    schema = "customerID long, transaction_count long, distinct_products long, days_since_last_purchase int, spend_tier int"
    df = spark.createDataFrame(data, schema)
    scored = M.batch_score(M.fit_tier_model(df.repartition(3), 10, 4), df)
    again = M.batch_score(M.fit_tier_model(df.repartition(6), 10, 4), df)
    assert scored.columns == [*df.columns, "predicted_tier"]
    assert sorted(scored.collect()) == sorted(again.collect())
    assert M.classification_metrics(scored, "spend_tier", "predicted_tier").first().accuracy > 0.95
