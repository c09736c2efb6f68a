"""Number columns: rates over text flags and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    """part / whole as decimal(6,4), by way of five decimals as a decimal average has."""
    exact = part.cast("decimal(18,0)") / whole.cast("decimal(18,0)")
    return F.round(exact.cast("decimal(6,5)"), 4).cast("decimal(6,4)")


def money(amount: Column | str) -> Column:
    """$ with thousands separators and no decimals: 1234.5 -> $1,234."""
    return F.concat(F.lit("$"), F.format_number(F.col(amount) if isinstance(amount, str) else amount, 0))


def grouped_number(value: Column | str) -> Column:
    """Thousands separators: 1234 -> 1,234."""
    return F.format_number(F.col(value) if isinstance(value, str) else value, 0)


def plain_number(value: Column) -> Column:
    """No decimals and no separators: 1234.5 -> 1234 (half to even)."""
    return F.replace(F.format_number(value, 0), F.lit(","), F.lit(""))
