"""Sales medallion: typed and validated layers, daily and per-state revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.expectations import apply_expectations


def sales_constraints() -> dict[str, Column]:
    """Checked on the typed columns, so 0.5 becomes 0 and fails."""
    return {
        "valid_quantity": F.col("quantity") > 0,
        "valid_amount": F.col("total_price") > 0,
        "has_transaction_date": F.col("transaction_date").isNotNull(),
    }


def customer_constraints() -> dict[str, Column]:
    return {"has_customer_id": F.col("customerID").isNotNull()}


def typed_sales(bronze_sales: DataFrame) -> DataFrame:
    """Typed projection.  Text that is no number or date becomes NULL, not an error."""
    return bronze_sales.select(
        "transactionID",
        "customerID",
        "product",
        F.col("quantity").try_cast("int").alias("quantity"),
        F.col("totalPrice").try_cast("double").alias("total_price"),
        F.col("dateTime").try_cast("date").alias("transaction_date"),
    )


def silver_sales(bronze_sales: DataFrame) -> DataFrame:
    return apply_expectations(typed_sales(bronze_sales), sales_constraints())


def customer_columns(bronze_customers: DataFrame) -> DataFrame:
    return bronze_customers.select("customerID", "first_name", "last_name", "city", "state", "country")


def silver_customers(bronze_customers: DataFrame) -> DataFrame:
    return apply_expectations(customer_columns(bronze_customers), customer_constraints())


def gold_daily_revenue(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("transaction_date")
        .agg(
            F.sum("total_price").alias("daily_revenue"),
            F.count("transactionID").alias("transaction_count"),
        )
        .withColumns({"year": F.year("transaction_date"), "month": F.month("transaction_date")})
    )


def customer_totals(silver: DataFrame) -> DataFrame:
    """Revenue and number of sales per customer; sales without one are left out."""
    return (
        silver.filter(F.col("customerID").isNotNull())
        .groupBy("customerID")
        .agg(F.sum("total_price").alias("revenue"), F.count("transactionID").alias("sales"))
    )


def revenue_by_state(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per state of the sums per customer.  Repeated customer rows fan out in the sums as a plain join would."""
    states = customers.groupBy("customerID", "state").agg(F.count(F.lit(1)).alias("copies"))
    return (
        totals.join(states, "customerID")
        .groupBy("state")
        .agg(
            F.sum(F.col("revenue") * F.col("copies")).alias("state_revenue"),
            F.sum(F.col("sales") * F.col("copies")).alias("transaction_count"),
        )
    )


def gold_revenue_by_state(silver: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per customer state; sales without a customer vanish.

    Sales are summed per customer before the join, so a customer with a third of
    all sales crosses the shuffle as one row per map task, and the join reuses
    the partitioning of that aggregate.  Repeated customer rows are counted
    instead of multiplied out.
    """
    return revenue_by_state(customer_totals(silver), customers)
