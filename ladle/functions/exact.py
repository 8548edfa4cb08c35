"""Aggregates that give the same bits however the rows are partitioned.

Minutes and money are decimals, so their sums are exact; the one division at
the end is the only rounding step. A task that is run again after an executor
was lost therefore returns what it returned before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean(value: Column) -> Column:
    """Average over the non-null values; null when there are none."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def share_pct(condition: Column) -> Column:
    """Percent of all rows meeting a condition; a null condition is not met."""
    return F.lit(100.0) * F.count_if(condition) / F.nullif(F.count(F.lit(1)), F.lit(0))


def two_places(value: Column) -> Column:
    """A JSON number with at most two decimals as an exact decimal."""
    return value.cast("decimal(18,2)")


def scalar(df: DataFrame, expression: Column) -> Column:
    """One value computed over a table, used as a column of another query."""
    return df.select(expression).scalar()


def latest(df: DataFrame, ts: str = "order_ts") -> Column:
    return scalar(df, F.max(ts))
