from pyspark.sql import functions as F

from goldleaf.operators import modelling as M
from goldleaf.plans.retraining import ModelRuns


def split(spark, noise=0):
    """Customers whose tier is their number of transactions, in part."""
    return spark.range(400).select(
        F.col("id").alias("customerID"),
        (F.col("id") % 30).alias("transaction_count"),
        (F.col("id") % 7).alias("distinct_products"),
        (F.col("id") % 11).alias("days_since_last_purchase"),
        F.when(F.pmod(F.xxhash64("id"), F.lit(100)) < noise, F.col("id") % 3).otherwise(F.floor(F.col("id") % 30 / 10)).cast("int").alias("spend_tier"),
        F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("split"),
    )


def test_the_champion_changes_only_through_the_gate(spark, tmp_path):
    runs = ModelRuns(spark, str(tmp_path))
    champion = lambda: [(r.run_id, r.model) for r in runs.champion().collect()]
    runs.fit(split(spark, 60), "a", (3, 1))
    assert champion() == [("a", "spend_tier")]
    runs.fit(split(spark, 60), "b", (3, 1))  # as good as the champion: it stays
    assert champion() == [("a", "spend_tier")]
    runs.fit(split(spark), "c", (10, 5))
    for _ in range(2):
        assert champion() == [("c", "spend_tier")]
        runs.fit(split(spark, 90), "d", (2, 1))  # worse, and repeated
    log = {r.run_id: r.f1 for r in runs.log.read().collect()}
    assert set(log) == {"a", "b", "c", "d"} and log["a"] == log["b"] and log["c"] == max(log.values())


def test_a_run_lost_between_log_and_judgement_is_judged_when_repeated(spark, tmp_path, monkeypatch):
    runs = ModelRuns(spark, str(tmp_path))
    runs.fit(split(spark, 60), "a", (3, 1))
    monkeypatch.setattr(runs.champions, "apply", lambda *_: 1 / 0)
    try:
        runs.fit(split(spark), "b", (10, 5))
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert runs.champion().first().run_id == "a" and runs.log.read().count() == 2
    runs.fit(split(spark), "b", (10, 5))
    assert runs.champion().first().run_id == "b" and runs.log.read().count() == 2


def test_a_stored_model_scores_as_before(spark, tmp_path):
    rows = split(spark)
    model = M.fit_tier_model(rows, 5, 3)
    loaded = M.round_trip(model, str(tmp_path / "m"))
    scores = lambda m: sorted(map(tuple, M.batch_score(m, rows).select("customerID", "predicted_tier").collect()))
    assert scores(model) == scores(loaded)
    check = M.scoring_check(loaded, M.batch_score(loaded, rows)).first()
    assert (check.n, check.trees, check.depth, check.n_classes, check.known_classes, check.beats_largest_class) == (400, 5, 3, 3, True, True)


def test_the_check_sees_bad_scores(spark):
    class Model:
        class Forest:
            getNumTrees, numClasses = 1, 2
            getOrDefault = staticmethod(lambda _: 1)
        stages = [Forest]

    scored = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (1, 7)], "spend_tier int, predicted_tier int")
    check = M.scoring_check(Model, scored).first()
    assert (check.n, check.known_classes, check.beats_largest_class) == (4, False, False)
