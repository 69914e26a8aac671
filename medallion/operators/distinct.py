"""Exact distinct counts that can be merged: bitmaps over numbered values.

``count(distinct)`` has to start from the rows for every grouping.  Here each value gets a
number once (``number_values``), a segment keeps which numbers it has seen as bitmaps of
32,768 bits (``distinct_state``), and any coarser grouping, or a later batch, is the union of
bitmaps (``merge_states``), counted exactly (``distinct_counts``).  A state has at most one row
per segment and bitmap, however many rows a value or a segment had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.session import settle


def number_values(df: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``value`` and ``number`` for every distinct non-NULL value; runs a job.

    Numbers are dense within the tasks that give them, so bitmaps are well filled.  With
    ``known``, an earlier result, old values keep their number and new ones follow.
    """
    values = df.select(F.col(column).alias("value")).where("value is not null").distinct()
    start = F.lit(0).cast("bigint")
    if known is not None:
        values = values.join(known, "value", "left_anti")
        start = F.coalesce(known.agg(F.max("number") + 1).scalar(), start)
    # stored: another evaluation would give other numbers
    fresh = settle(values.select(
        "value", (F.monotonically_increasing_id() + start).alias("number")), "value-numbers")
    return fresh if known is None else known.unionByName(fresh)


def distinct_state(df: DataFrame, groups: Sequence[str], column: str,
                   numbers: DataFrame) -> DataFrame:
    """``groups``, ``bucket``, ``bits``: which numbered values each group holds.

    Rows are reduced to one per group and value before they meet the numbers.
    """
    seen = df.select(*groups, F.col(column).alias("value")).where("value is not null").distinct()
    placed = seen.join(numbers, "value").select(
        *groups, F.call_function("bitmap_bucket_number", F.col("number")).alias("bucket"),
        F.call_function("bitmap_bit_position", F.col("number")).alias("_bit"))
    return placed.groupBy(*groups, "bucket").agg(
        F.call_function("bitmap_construct_agg", F.col("_bit")).alias("bits"))


def merge_states(state: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The state of coarser ``groups``, or of several states in one (their union)."""
    return state.groupBy(*groups, "bucket").agg(
        F.call_function("bitmap_or_agg", F.col("bits")).alias("bits"))


def distinct_counts(state: DataFrame, groups: Sequence[str], out: str) -> DataFrame:
    """Distinct values per group of a state, or of a coarser grouping of it."""
    merged = merge_states(state, groups)
    return merged.groupBy(*groups).agg(
        F.sum(F.call_function("bitmap_count", F.col("bits"))).alias(out))
