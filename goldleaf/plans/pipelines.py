"""Builds: sources to stored layers, in dependency order.

Each step writes a table and the next one reads that table, so a layer is
computed once and a lost job is repeated from the last stored layer.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators import features as X
from goldleaf.operators import finance as N
from goldleaf.operators import modelling as M
from goldleaf.operators import sales as S
from goldleaf.operators import travel as V
from goldleaf.operators.expectations import observed_expectations
from goldleaf.sources.tables import bronze, record_rows, replace_table, save_overwrite


@dataclass
class BuildReport:
    """What a build stored, and the expectation counts of its silver steps."""

    tables: list[str] = field(default_factory=list)
    expectations: dict[str, dict[str, int]] = field(default_factory=dict)


class _Schema:
    """Tables of one schema, written and read back by name."""

    def __init__(self, spark: SparkSession, schema: str) -> None:
        self.spark, self.schema, self.report = spark, schema, BuildReport()

    def store(self, name: str, df: DataFrame, partition_by: Iterable[str] = ()) -> DataFrame:
        full = f"{self.schema}.{name}"
        replace_table(df, full, partition_by)
        self.report.tables.append(full)
        return self.spark.table(full)

    def store_expected(self, name: str, df: DataFrame, constraints: dict[str, Column]) -> DataFrame:
        """Store the rows that meet the constraints; the write itself counts the others."""
        counts = Observation(name)
        stored = self.store(name, observed_expectations(df, constraints, counts))
        self.report.expectations[name] = dict(counts.get)
        return stored


def build_sales(spark: SparkSession, schema: str, transactions: DataFrame, customers: DataFrame) -> BuildReport:
    """Bronze, silver with expectations, and the two gold sales tables."""
    to = _Schema(spark, schema)
    raw_sales = to.store("bronze_sales_transactions", bronze(transactions))
    raw_customers = to.store("bronze_sales_customers", bronze(customers))
    sales = to.store_expected("silver_sales_transactions", S.typed_sales(raw_sales), S.sales_constraints())
    known = to.store_expected(
        "silver_sales_customers", S.customer_columns(raw_customers), S.customer_constraints()
    )
    to.store("gold_daily_revenue", S.gold_daily_revenue(sales))
    to.store("gold_revenue_by_state", S.gold_revenue_by_state(sales, known))
    return to.report


def build_travel(
    spark: SparkSession,
    schema: str,
    bookings: DataFrame,
    properties: DataFrame,
    destinations: DataFrame,
    payments: DataFrame,
) -> BuildReport:
    """Bronze copies, enriched silver bookings and the four gold travel tables."""
    to = _Schema(spark, schema)
    raw = {
        name: to.store(f"bronze_{name}", bronze(df))
        for name, df in {
            "bookings": bookings,
            "properties": properties,
            "destinations": destinations,
            "payments": payments,
        }.items()
    }
    silver = to.store(
        "silver_bookings", V.silver_bookings(raw["bookings"], raw["properties"], raw["destinations"])
    )
    to.store("gold_revenue_by_destination", V.gold_revenue_by_destination(silver))
    to.store("gold_monthly_revenue", V.gold_monthly_revenue(silver))
    to.store("gold_revenue_by_property_type", V.gold_revenue_by_property_type(silver))
    to.store("gold_payment_methods", V.gold_payment_methods(raw["payments"], silver))
    return to.report


def build_finance(spark: SparkSession, schema: str, cashflow: DataFrame, vendor_lines: DataFrame) -> BuildReport:
    """The two finance gold tables; the sources are read in place."""
    to = _Schema(spark, schema)
    to.store("gold_monthly_cashflow", N.gold_monthly_cashflow(cashflow))
    to.store("gold_vendor_performance", N.gold_vendor_performance(vendor_lines))
    return to.report


def retrain(
    spark: SparkSession,
    schema: str,
    as_of: Column,
    run_id: str,
    model_path: str,
    configuration: tuple[int, int] = M.CONFIGURATIONS[1],
) -> PipelineModel:
    """Scheduled retraining over the stored silver sales.

    Rebuilds the feature table, fits one configuration, records its metrics in
    the run log (a repeated run replaces its row) and saves the model under ``model_path``/``run_id``.  The new run
    becomes the champion only if it beats the F1 of the present one.
    """
    built = X.customer_features(spark.table(f"{schema}.silver_sales_transactions"), as_of)
    # stored once unlabelled: the cuts and the labels are separate passes over it
    replace_table(built, f"{schema}.customer_features__unlabelled")
    plain = spark.table(f"{schema}.customer_features__unlabelled")
    replace_table(X.with_spend_tier(plain, X.exact_cuts(plain)), f"{schema}.customer_features")
    spark.sql(f"DROP TABLE {schema}.customer_features__unlabelled")

    split = X.stratified_split(spark.table(f"{schema}.customer_features"), "spend_tier", "customerID")
    replace_table(split, f"{schema}.customer_features_split")
    split = spark.table(f"{schema}.customer_features_split")
    trees, depth = configuration
    model = M.fit_tier_model(split.filter("split = 'train'"), trees, depth)
    model = M.round_trip(model, f"{model_path}/{run_id}")
    scored = M.batch_score(model, split.filter("split = 'test'"))
    run = M.run_row(M.classification_metrics(scored, "spend_tier", "predicted_tier"), run_id, trees, depth)
    record_rows(run, f"{schema}.model_runs", "run_id")

    run = spark.table(f"{schema}.model_runs").filter(F.col("run_id") == run_id)
    champion_table = f"{schema}.model_champion"
    if not spark.catalog.tableExists(champion_table):
        save_overwrite(run, champion_table)
    else:
        champion = spark.table(champion_table)
        gated = M.promotion_gate(run, champion).filter("promote").select(*run.columns)
        # the winner of one or two rows, so that the table is never left empty
        replace_table(M.best_run(champion.unionByName(gated)), champion_table)
    return model
