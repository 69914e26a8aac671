"""Report filters: default choices, ranges and latest-period snapshots.

Single values come from scalar subqueries, so a choice made by the data is one
small aggregate inside the same query and not a driver round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values in ascending order."""
    return df.select(column).dropna().distinct().orderBy(column)


def first_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The first ``n`` distinct values; a top-k of at most ``n`` rows."""
    return distinct_values(df, column).limit(n)


def pick_value(df: DataFrame, column: str, value: object | None = None) -> DataFrame:
    """Rows of one category; without ``value`` the first one in sort order."""
    if value is not None:
        return df.where(F.col(column) == F.lit(value))
    return df.where(F.col(column) == df.select(F.min(column)).scalar())


def value_range(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value, as one row ``(low, high)``."""
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def between_inclusive(df: DataFrame, column: str, low: object | None = None,
                      high: object | None = None) -> DataFrame:
    """Rows inside an inclusive range; an open end means the data's own bound.

    Rows whose value is NULL lie in no range and drop out.
    """
    keep = F.col(column).isNotNull()
    if low is not None:
        keep = keep & (F.col(column) >= F.lit(low))
    if high is not None:
        keep = keep & (F.col(column) <= F.lit(high))
    return df.where(keep)


def latest_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows of the most recent period."""
    return df.where(F.col(column) == df.select(F.max(column)).scalar())
