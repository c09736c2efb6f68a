"""Named row expectations: drop the rows that fail, count them per constraint."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Constraints = Mapping[str, Column]


def _met(condition: Column) -> Column:
    """A condition that is NULL counts as failed."""
    return F.coalesce(condition, F.lit(False))


def meets_all(constraints: Constraints) -> Column:
    return reduce(lambda a, b: a & b, [_met(c) for c in constraints.values()])


def apply_expectations(df: DataFrame, constraints: Constraints) -> DataFrame:
    """Rows that meet every constraint.  Conditions name the columns of ``df``.

    A filter drops NULL conditions by itself; the bare conditions can be pushed
    down to the scan, one by one.
    """
    for condition in constraints.values():
        df = df.filter(condition)
    return df


def _tallies(constraints: Constraints) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("checked_rows"),
        F.count_if(~meets_all(constraints)).alias("dropped_rows"),
        *[F.count_if(~_met(c)).alias(name) for name, c in constraints.items()],
    ]


def expectation_counts(df: DataFrame, constraints: Constraints, dataset: str) -> DataFrame:
    """Failures per constraint from one pass: dataset, constraint, failed, dropped, checked.

    A row failing several constraints counts once in each of them and once in
    ``dropped_rows``.
    """
    per_constraint = F.array(
        *[
            F.struct(F.lit(name).alias("constraint_name"), F.col(name).alias("failed_rows"))
            for name in constraints
        ]
    )
    return (
        df.agg(*_tallies(constraints))
        .select("checked_rows", "dropped_rows", F.inline(per_constraint))
        .select(
            F.lit(dataset).alias("dataset"), "constraint_name", "failed_rows", "dropped_rows", "checked_rows"
        )
    )


def observed_expectations(
    df: DataFrame, constraints: Constraints, observation: Observation
) -> DataFrame:
    """As apply_expectations, but the counts come with the job that writes the rows.

    After the write, ``observation.get`` holds checked_rows, dropped_rows and one
    entry per constraint, so no second pass over the data is needed.
    """
    return apply_expectations(df.observe(observation, *_tallies(constraints)), constraints)
