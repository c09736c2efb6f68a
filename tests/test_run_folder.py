"""Intermediate tables belong to a run and go with it."""

from pathlib import Path

import pytest

from goldleaf import session
from goldleaf.operators.features import range_counts
from goldleaf.sources.tables import materialize


def test_a_run_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    before = sorted(p.name for p in tmp_path.iterdir())
    with session.run(spark):
        assert materialize(spark.range(3), "x").count() == 3
        assert [p.parent.name for p in tmp_path.glob("*/x-*")] == [f"goldleaf-{spark.sparkContext.applicationId}"]
    assert sorted(p.name for p in tmp_path.iterdir()) == before == []


def test_a_cluster_must_name_the_shared_folder(spark):
    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,1024]"

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError):
        session.shared_dir(Session)
    Context.master = "local[4]"
    assert Path(session.shared_dir(Session)).is_dir()


def test_cuts_are_counted_without_a_single_task(spark):
    values = spark.range(0, 100_000, numPartitions=8).selectExpr("double(id) AS v")
    plan = range_counts(values, [(0.0, 99_999.0)] * 2, 64)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan and "Sort " not in plan
    assert plan.count("HashAggregate") == 2
