"""Spend-tier classifier on pyspark.ml: fit, metrics, run log, promotion, scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The label comes from total_spend, so spend itself is no feature.
FEATURES = ("transaction_count", "distinct_products", "days_since_last_purchase")
# (trees, depth) of the two compared configurations; a retrain uses the second.
CONFIGURATIONS = ((50, 4), (200, 8))
SEED = 42
FIT_PARTITIONS = 8  # more for more rows; part of what a model depends on, like the seed


def fit_tier_model(
    train: DataFrame,
    trees: int,
    depth: int,
    features: Sequence[str] = FEATURES,
    label: str = "spend_tier",
    id_column: str = "customerID",
    seed: int = SEED,
    partitions: int = FIT_PARTITIONS,
) -> PipelineModel:
    """Random forest on the executors; training rows never reach the driver.

    The narrow training columns are dealt by id to ``partitions`` and sorted within
    each.  The forest draws its samples per partition and position, so a seed and
    a number of partitions give the same model on any cluster, whatever the files
    look like, and again after a lost executor.
    """
    rows = (
        train.select(id_column, *features, label)
        .repartition(partitions, id_column)
        .sortWithinPartitions(id_column)
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        # rows remember their tree node, instead of walking every tree again per level
        cacheNodeIds=True,
    )
    return Pipeline(stages=[assembler, forest]).fit(rows)


def batch_score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the predicted tier; the model's vectors are dropped."""
    return model.transform(rows).select(*rows.columns, F.col("prediction").cast("int").alias("predicted_tier"))


def round_trip(model: PipelineModel, path: str) -> PipelineModel:
    """Store the model under ``path``, which must be on shared storage, and load it again."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def scoring_check(model: PipelineModel, scored: DataFrame, label: str = "spend_tier", predicted: str = "predicted_tier") -> DataFrame:
    """What must hold of a model and the labelled rows it scored, as one row.

    n; the trees, depth limit and classes of the model; whether every row got a
    class that is a label; and whether as many are right as by always naming the
    largest class.
    """
    forest = model.stages[-1]
    cells = confusion(scored, label, predicted)
    per_label = cells.groupBy("label").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hits")
    )
    unknown = cells.join(per_label.select(F.col("label").alias("predicted")), "predicted", "left_anti")
    return per_label.agg(
        F.sum("n").alias("n"),
        F.lit(forest.getNumTrees).alias("trees"),
        F.lit(forest.getOrDefault("maxDepth")).alias("depth"),
        F.lit(forest.numClasses).alias("n_classes"),
        (F.lit(unknown.count()) == 0).alias("known_classes"),
        (F.sum("hits") >= F.max("n")).alias("beats_largest_class"),
    )


def confusion(scored: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return (
        scored.filter(F.col(label).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(*by, F.col(label).alias("label"), F.col(predicted).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def classification_metrics(scored: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """n, accuracy and F1 weighted by class support, per group of ``by``.

    All figures come from the confusion counts, so the rows are read once.  A
    class that is never predicted has F1 zero.
    """
    cells = confusion(scored, label, predicted, by)
    # each cell counts for its true class and for its predicted class
    sides = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called")),
            )
        ).alias("side"),
        F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits"),
    )
    per_class = sides.groupBy(*by, F.col("side.class").alias("class")).agg(
        F.sum("side.support").alias("support"),
        F.sum("side.called").alias("called"),
        # every diagonal cell appears on both of its sides
        (F.sum("hits") / 2).alias("hits"),
    )
    f1 = 2 * F.col("hits") / (F.col("support") + F.col("called"))
    return per_class.groupBy(*by).agg(
        F.sum("support").alias("n"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        (F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1"),
    )


def run_row(metrics: DataFrame, run_id: str, trees: int, depth: int) -> DataFrame:
    """A run-log row: id, parameters, metrics."""
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(trees).alias("trees"),
        F.lit(depth).alias("depth"),
        "n",
        "accuracy",
        "f1",
    )


def best_run(runs: DataFrame) -> DataFrame:
    """The run with the highest F1; the smaller id wins a tie."""
    return runs.orderBy(F.desc_nulls_last("f1"), F.asc("run_id")).limit(1)


def promotion_gate(candidates: DataFrame, champion: DataFrame) -> DataFrame:
    """Candidates with the champion's F1 and whether they take over.

    A candidate is promoted only if it beats the champion; without a champion
    (or without its F1) it is promoted.
    """
    reigning = champion.select(F.max("f1")).scalar()
    return candidates.withColumn("champion_f1", reigning).withColumn(
        "promote",
        F.coalesce(F.col("f1") > F.col("champion_f1"), F.col("champion_f1").isNull() & F.col("f1").isNotNull()),
    )
