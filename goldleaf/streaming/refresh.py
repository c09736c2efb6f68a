"""Incremental refresh of the sales layers.

The pipeline declares its layers as refreshed views.  Reading all transactions
again for each refresh is wasteful once they are many, so only what has arrived
is carried on: the source is read once, a batch of it becomes a part of bronze,
that part becomes a part of silver, and the sums of the part are added to the
stored sums per day and per customer.  The checkpoint folder remembers what was
read.  A batch that is repeated after a failure replaces its own parts, and its
sums are added once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators.expectations import apply_expectations
from goldleaf.operators.sales import customer_totals, gold_daily_revenue, revenue_by_state, sales_constraints, typed_sales
from goldleaf.sources.stored import PartitionedTable
from goldleaf.sources.tables import bronze

SALES = "transactionID long, customerID long, product string, quantity double, totalPrice double, dateTime timestamp_ntz"
DAILY = "transaction_date date, daily_revenue double, transaction_count long, year int, month int"
TOTALS = "customerID long, revenue double, sales long, bucket int"
BUCKETS = 64  # folders of the sums per customer


class SalesLayers:
    """Bronze, silver and two stored aggregates under one folder, which must be on shared storage."""

    def __init__(self, spark: SparkSession, layer_dir: str, buckets: int = BUCKETS) -> None:
        self.spark, self.buckets = spark, buckets
        self.bronze_path = f"{layer_dir}/bronze_sales_transactions"
        self.silver_path = f"{layer_dir}/silver_sales_transactions"
        # a batch rewrites the months and the buckets that it has sales of
        self.daily = PartitionedTable(spark, f"{layer_dir}/gold_daily_revenue", DAILY, ["year", "month"])
        self.totals = PartitionedTable(spark, f"{layer_dir}/customer_totals", TOTALS, ["bucket"])

    def _store(self, rows: DataFrame, path: str, batch_id: int) -> DataFrame:
        part = f"{path}/load_batch={batch_id}"
        rows.write.mode("overwrite").parquet(part)
        return self.spark.read.schema(rows.schema).parquet(part)

    def load(self, arrived: DataFrame, batch_id: int) -> None:
        """Carry one batch through all layers."""
        raw = self._store(bronze(arrived), self.bronze_path, batch_id)
        valid = self._store(apply_expectations(typed_sales(raw), sales_constraints()), self.silver_path, batch_id)
        self.daily.add(f"batch-{batch_id}", gold_daily_revenue(valid), ["daily_revenue", "transaction_count"])
        bucket = F.pmod(F.xxhash64("customerID"), F.lit(self.buckets)).cast("int").alias("bucket")
        self.totals.add(f"batch-{batch_id}", customer_totals(valid).select("*", bucket), ["revenue", "sales"])

    def revenue_by_state(self, customers: DataFrame) -> DataFrame:
        """From the stored sums per customer and the customers as they are now, so a move needs no refresh."""
        return revenue_by_state(self.totals.read(), customers)

    def refresh(self, source_dir: str, checkpoint_dir: str, schema: str = SALES, files_per_batch: int = 1000) -> None:
        """Load the files that have come since the last call, in batches of so many files."""
        arrivals = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
        (
            arrivals.writeStream.foreachBatch(self.load)
            .option("checkpointLocation", f"{checkpoint_dir}/sales_transactions")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )


def refresh_sales(spark: SparkSession, source_dir: str, layer_dir: str, checkpoint_dir: str, schema: str = SALES) -> DataFrame:
    """Carry new transaction files to bronze, silver and gold; returns the daily revenue.

    ``layer_dir`` and ``checkpoint_dir`` must be on shared storage.
    """
    layers = SalesLayers(spark, layer_dir)
    layers.refresh(source_dir, checkpoint_dir, schema)
    return layers.daily.read()
