"""Distinct rows by digest: only rows that may be repeated are shuffled whole.

``dropDuplicates`` shuffles every distinct row with all its columns.  Where few rows repeat,
nearly all of that is wasted.  Here a row is first known by 128 bits:

1. digests are counted (16 bytes a row, pre-aggregated), and those that stand for more than
   one row go into a bit filter of fixed size, which can be broadcast whatever the input;
2. a row outside the filter is the only one of its digest, hence the only one of its
   content: it passes without a shuffle;
3. a row inside it (repeated, or there by chance) is compared whole, copies collapsing on
   the map side first.

Two different rows of one digest are both inside the filter and are told apart by step 3, so
the result is exact for any hash.  A filter that overflows lets more rows into step 3 and
changes nothing else.  ``df`` is read three times; it pays when reading is cheap against
shuffling, as for stored tables, and rows are wide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_WORDS = 1 << 18  # of 64 bits; the broadcast filter has at most so many rows


def _digest(df: DataFrame) -> tuple[Column, Column]:
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *reversed(columns))


def _word(h: Column) -> Column:
    # never NULL; saying so spares the join a filter that hashes the row once more
    return F.coalesce(F.pmod(h, F.lit(FILTER_WORDS)).cast("int"), F.lit(0))


def _mask(h: Column) -> Column:
    """Two of a word's 64 bits, chosen by the second half of the digest."""
    one, two = (F.pmod(F.shiftright(h, s), F.lit(64)).cast("int") for s in (0, 32))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), one).bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), two))


def repeated_filter(df: DataFrame) -> DataFrame:
    """``_w``, ``_bits``: the filter of all digests that stand for more than one row."""
    first, second = _digest(df)
    counted = df.select(first.alias("_d1"), second.alias("_d2")).groupBy("_d1", "_d2").agg(
        F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return counted.groupBy(_word(F.col("_d1")).alias("_w")).agg(
        F.bit_or(_mask(F.col("_d2"))).alias("_bits"))


def mark_repeated(df: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """``df`` plus a flag: false for a row that is surely the only one with its values of
    ``by``, true for all others (and a few more by chance).  No row is shuffled."""
    # by position, so that no column name can clash with those of the filter
    names = [f"c{i}" for i in range(len(df.columns))]
    rows, columns = df.toDF(*names), [names[df.columns.index(c)] for c in by]
    first, second = _digest(rows.select(*columns))
    bits = F.broadcast(repeated_filter(rows.select(*columns)))
    marked = rows.withColumns({"_w": _word(first), "_m": _mask(second)}).join(bits, "_w", "left")
    inside = F.coalesce(F.col("_bits").bitwiseAND(F.col("_m")) == F.col("_m"), F.lit(False))
    return marked.select(*names, inside.alias("_in")).toDF(*df.columns, out)


def distinct_by_digest(df: DataFrame) -> DataFrame:
    """The rows of ``df.distinct()``."""
    names = [f"c{i}" for i in range(len(df.columns))]
    marked = mark_repeated(df.toDF(*names), names, "_in")
    alone, copied = (marked.where(c).drop("_in") for c in ("not _in", "_in"))
    return alone.unionByName(copied.dropDuplicates()).toDF(*df.columns)
