"""Model runs of a scheduled retraining, and the champion that they may replace.

Everything is stored under one folder: a model per run, a log with a partition
per run, and the champion of each kind of model.  A run that is repeated
replaces its own model and row, and is judged once.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators import modelling as M
from goldleaf.sources.stored import PartitionedTable

RUN = "trees int, depth int, n long, accuracy double, f1 double, run_id string"
SPEND_TIER = "spend_tier"


class ModelRuns:
    """The runs of one kind of model under ``folder``, which must be on shared storage."""

    def __init__(self, spark: SparkSession, folder: str, model: str = SPEND_TIER) -> None:
        self.folder, self.model = folder, model
        self.log = PartitionedTable(spark, f"{folder}/runs", RUN, ["run_id"])
        self.champions = PartitionedTable(spark, f"{folder}/champions", f"{RUN}, model string", ["model"])

    def champion(self) -> DataFrame:
        return self.champions.read().where(F.col("model") == self.model)

    def fit(self, split: DataFrame, run_id: str, configuration: tuple[int, int]) -> PipelineModel:
        """Fit on the train part, store the model, log the metrics of the stored one on the test part, and judge it."""
        trees, depth = configuration
        fitted = M.fit_tier_model(split.where("split = 'train'"), trees, depth)
        stored = M.round_trip(fitted, f"{self.folder}/models/{run_id}")
        scored = M.batch_score(stored, split.where("split = 'test'"))
        metrics = M.classification_metrics(scored, "spend_tier", "predicted_tier")
        self.log.replace(M.run_row(metrics, run_id, trees, depth))
        self.champions.apply(run_id, lambda: self._winner(run_id))
        return stored

    def _winner(self, run_id: str) -> DataFrame:
        """The champion, or the run if it passes the gate."""
        champion = self.champion()
        run = self.log.read().where(F.col("run_id") == run_id).withColumn("model", F.lit(self.model))
        gated = M.promotion_gate(run, champion).where("promote").select(*champion.columns)
        return M.best_run(champion.unionByName(gated))
