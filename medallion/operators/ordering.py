"""Order-based operators that never gather an unbounded group in one task.

``row_number``, ``ntile`` and running totals are sequential per window
partition: with no partition, or with one key holding a third of the rows, a
plain window runs in one task.  Each operator here cuts the order into pieces
small enough for one task, counts the pieces, and adds the offset of the
pieces before.

Where a single order value may hold very many rows, ties go by ``md5(key), key``.
Any fixed order is as good as another for ties; the leading md5 digits split the
tied rows evenly, so even a value shared by a third of all rows spreads out.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.enrich import join_null_safe, null_safe
from medallion.session import settle

_LANES = 256


def _tie(key: str) -> list[Column]:
    return [F.md5(F.col(key).cast("string")), F.col(key)]


def _lane(key: str) -> Column:
    """0..255, ordered like md5(key)."""
    head = F.coalesce(F.substring(F.md5(F.col(key).cast("string")), 1, 2), F.lit("00"))
    return F.conv(head, 16, 10).cast("int")


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  value: str, out: str) -> DataFrame:
    """Running sum of ``value`` per ``keys`` in ascending ``order``, NULLs last.

    ``order`` must be unique per key.  Its first column is the coarse step (a
    day, a month): rows are summed inside a step, and the total of all earlier
    steps is added.  One task holds one step of one key, or one row per step.
    An action: both halves read ``df`` from a copy that is stored when this is called.  It
    is an aggregate, far smaller than the facts behind it, which are scanned once.
    """
    df = settle(df, "running-total")
    step, rest = order[0], list(order[1:])
    cells = [*keys, step]
    by_step = df.groupBy(*cells).agg(F.sum(value).alias("_step_total"))
    before = by_step.select(
        *cells,
        F.coalesce(
            F.sum("_step_total").over(
                Window.partitionBy(*keys).orderBy(F.col(step).asc_nulls_last())
                .rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_before"),
    )
    inside = df.withColumn(
        "_inside",
        F.sum(value).over(
            Window.partitionBy(*cells).orderBy(*(F.col(c).asc_nulls_last() for c in rest))
            .rowsBetween(Window.unboundedPreceding, 0)) if rest else F.col(value),
    )
    return inside.join(before, null_safe(inside, before, cells)).select(
        *(inside[c] for c in df.columns),
        (inside["_inside"] + before["_before"]).alias(out),
    )


def number_rows(df: DataFrame, keys: Sequence[str], newest_first: str, tie: str, out: str,
                hot_rows: int = 5_000_000) -> DataFrame:
    """``row_number`` per ``keys``, latest ``newest_first`` day first.

    Ties go by ``md5(tie), tie``.  Keys with up to ``hot_rows`` rows take the plain
    window; the others are cut into (day, md5 lane) pieces, one lane for each
    ``hot_rows`` rows of the key, which gives the same numbers.  How the list of hot
    keys is joined is left to Spark, which knows its size at run time; when it
    is empty, adaptive execution drops the second branch.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") > hot_rows).select(
        *(F.col(k).alias(f"_hot_{k}") for k in keys),
        F.ceil(F.col("_n") / F.lit(hot_rows)).alias("_lanes"))
    is_hot = F.lit(True)
    for k in keys:
        is_hot = is_hot & F.col(k).eqNullSafe(F.col(f"_hot_{k}"))

    day = F.col(newest_first).desc_nulls_last()
    rest = df.join(hot, is_hot, "left_anti").withColumn(
        out, F.row_number().over(Window.partitionBy(*keys).orderBy(day, *_tie(tie)))
        .cast("bigint"))

    pieces = [*keys, newest_first, "_lane"]
    head = F.coalesce(F.substring(F.md5(F.col(tie).cast("string")), 1, 8), F.lit("0" * 8))
    place = F.conv(head, 16, 10).cast("bigint")  # 32 bits, ordered like md5(tie)
    busy = df.join(hot, is_hot).select(
        *(df[c] for c in df.columns),
        F.floor(place * F.col("_lanes") / F.lit(float(1 << 32))).alias("_lane"))
    numbered = busy.withColumn(
        "_inside",
        F.row_number().over(Window.partitionBy(*pieces).orderBy(*_tie(tie))))
    counts = busy.groupBy(*pieces).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        *pieces,
        F.coalesce(
            F.sum("_n").over(
                Window.partitionBy(*keys).orderBy(day, F.col("_lane"))
                .rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_before"))
    busy_out = numbered.join(before, null_safe(numbered, before, pieces)).select(
        *(numbered[c] for c in df.columns),
        (numbered["_inside"] + before["_before"]).cast("bigint").alias(out))
    return rest.unionByName(busy_out)


def rank_rows(df: DataFrame, keys: Sequence[str], highest_first: str, out: str,
              cuts: int = 127) -> DataFrame:
    """``RANK() OVER (PARTITION BY keys ORDER BY highest_first DESC NULLS LAST)``.

    ``highest_first`` is a number.  Each key's values are cut at approximate quantiles.
    Rows between two cuts are ranked in a task of their own; rows equal to a cut, or NULL,
    all tie, so they need no order and may lie in any number of tasks.  A value that holds
    more than about one row in ``cuts`` is a cut itself.  Since ties never lie in two
    pieces, a row's rank is its rank in its piece plus the rows in higher pieces.  The cuts
    decide who does the work, never the result; all is one lazy plan.
    """
    keys, v = list(keys), F.col(highest_first)
    shares = F.array(*(F.lit(i / (cuts + 1)) for i in range(1, cuts + 1)))
    points = df.groupBy(*keys).agg(
        F.array_distinct(F.percentile_approx(v, shares, F.lit(cuts * 8))).alias("_cuts"))
    placed = join_null_safe(df, points, keys, "left")
    known = v.isNotNull()
    above = F.size(F.filter("_cuts", lambda c: c > v))
    tied = ~known | F.coalesce(F.array_contains("_cuts", v), F.lit(False))
    placed = placed.withColumns({
        "_piece": F.when(known, above * 2 + F.when(tied, 1).otherwise(0))
        .otherwise(2 * cuts + 2),
        "_lane": F.when(tied, F.spark_partition_id()).otherwise(-1)}).drop("_cuts")
    pieces = [*keys, "_piece"]
    counts = placed.groupBy(*pieces).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(*pieces, (F.sum("_n").over(  # at most 2 * cuts + 3 rows per key
        Window.partitionBy(*keys).orderBy("_piece")) - F.col("_n")).alias("_before"))
    inside = placed.withColumn("_inside", F.rank().over(
        Window.partitionBy(*pieces, "_lane").orderBy(v.desc_nulls_last())))
    return join_null_safe(inside, before, pieces).select(
        *df.columns, (F.col("_inside") + F.col("_before")).cast("bigint").alias(out))


def _common_front(df: DataFrame, order: str) -> int:
    """Bytes that all texts of a column begin with, by its smallest and largest; a job."""
    ends = df.agg(F.min(order), F.max(order)).first()
    return len(os.path.commonprefix([(t or "").encode() for t in ends]))


def _as_number(df: DataFrame, order: str) -> tuple[Column, Column]:
    """A DOUBLE that sorts like ``order``, and whether it stands for one value only."""
    kind, c = df.schema[order].dataType, F.col(order)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double"), F.lit(True)
    if isinstance(kind, (T.TimestampType, T.LongType)):
        x = (F.unix_micros(c) if isinstance(kind, T.TimestampType) else c).cast("double")
        return x, F.abs(x) < F.lit(float(1 << 53))
    if isinstance(kind, T.StringType):
        # six bytes from where the values first differ
        front = F.rpad(F.hex(F.substring(c.cast("binary"), _common_front(df, order) + 1, 6)),
                       12, "0")
        return F.conv(front, 16, 10).cast("double"), F.lit(False)
    if isinstance(kind, T.DecimalType):
        return c.cast("double"), F.lit(False)
    if isinstance(kind, T.NumericType):
        return c.cast("double"), F.lit(True)
    raise TypeError(f"cannot order by {kind}")


def _cut_points(df: DataFrame, number: Column, cuts: int) -> list[float]:
    """At most ``cuts`` approximate quantiles, read to the driver as one row.

    Sketches of many tasks would all meet in one reducer, so they are merged in
    64 groups first and the quantiles of the groups' quantiles are taken.  That is
    rougher, but cut points only have to spread the rows.
    """
    shares = ", ".join(f"{i / (cuts + 1)!r}D" for i in range(1, cuts + 1))
    quantiles = F.expr(f"percentile_approx(x, array({shares}), {cuts * 2})")
    values = df.select(number.alias("x"),
                       (F.spark_partition_id() % 64).alias("g"))
    groups = values.where(F.col("x").isNotNull()).groupBy("g").agg(quantiles.alias("q"))
    found = groups.select(F.explode("q").alias("x")).agg(quantiles).first()[0]
    return sorted({p for p in found or [] if math.isfinite(p)}) or [0.0]


def _bucket(df: DataFrame, number: tuple[Column, Column], tie: str,
            points: list[float]) -> DataFrame:
    """Add ``_bucket``, a BIGINT that sorts like ``order`` and then ``md5(tie)``.

    A bucket holds either the rows equal to one cut point (or NULL, or NaN), of one
    of 256 md5 lanes, or the rows strictly between two cut points.  Where a cut point
    may stand for several values (texts with a common front, very large LONGs), its
    rows are one bucket.
    """
    value, single = number
    placed = Bucketizer(
        splits=[-math.inf, *points, math.inf], inputCol="_x", outputCol="_slot",
        handleInvalid="keep").transform(df.withColumns({"_x": value, "_single": single}))
    slot = F.when(F.col("_x").isNull(), len(points) + 2).otherwise(F.col("_slot").cast("int"))
    cut = F.get(F.from_json(F.lit(json.dumps(points)), "array<double>"), slot - 1)
    tied = F.col("_x").isNull() | F.isnan("_x") | F.coalesce(cut == F.col("_x"), F.lit(False))
    lane = F.when(F.col("_x").isNull() | F.isnan("_x") | F.col("_single"), _lane(tie))
    bucket = F.when(tied, slot.cast("bigint") * 2 * _LANES + F.coalesce(lane, F.lit(0))
                    ).otherwise((slot.cast("bigint") * 2 + 1) * _LANES)
    # never NULL; saying so spares the joins a second evaluation as a filter
    return placed.withColumn("_bucket", F.coalesce(bucket, F.lit(-1))).drop("_x", "_slot", "_single")


def _tile_of(rank: Column, total: Column, tiles: int) -> Column:
    """Tile of a 1-based rank when the first ``total % tiles`` tiles get one row more."""
    size = F.floor(total / tiles)
    extra = total % tiles
    in_big = extra * (size + 1)
    small = F.greatest(size, F.lit(1))
    return F.when(
        rank <= in_big, F.floor((rank - 1) / (size + 1)) + 1
    ).otherwise(extra + F.floor((rank - 1 - in_big) / small) + 1).cast("bigint")


def ntile_global(df: DataFrame, tiles: int, order: str, tie: str, out: str,
                 cuts: int = 1023) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY order NULLS LAST, md5(tie), tie)`` without one task.

    Rows fall into ordered buckets.  Counting the buckets gives the rank range of
    each.
    A bucket inside one tile is labelled by lookup; only the at most
    ``tiles - 1`` buckets that a tile boundary crosses (about ``tiles/cuts`` of
    the rows) are sorted.  The result is exact for any cut points, which are
    fetched once so that every branch sees the same ones.  Bucket counts are
    bounded by ``257 * cuts`` rows, so they are summed in one task and broadcast.

    ``df`` is read four times (narrow columns twice); store it first when it is
    the result of a costly plan.
    """
    number = _as_number(df, order)
    placed = _bucket(df, number, tie, _cut_points(df, number[0], cuts))
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.orderBy("_bucket")
    layout = counts.select(
        "_bucket",
        (F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_n")).alias("_before"),
        F.col("_n"),
        F.sum("_n").over(
            ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ).alias("_total"))
    layout = layout.select(
        "_bucket", "_before", "_total",
        _tile_of(F.col("_before") + 1, F.col("_total"), tiles).alias("_first"),
        _tile_of(F.col("_before") + F.col("_n"), F.col("_total"), tiles).alias("_last"))

    # bounded by 257 * cuts rows, so Spark may broadcast them
    whole = F.broadcast(layout.where("_first = _last").select("_bucket", "_first"))
    crossed = F.broadcast(layout.where("_first < _last").select("_bucket", "_before", "_total"))
    labelled = placed.join(whole, "_bucket").select(*df.columns, F.col("_first").alias(out))
    inside = Window.partitionBy("_bucket").orderBy(F.col(order).asc_nulls_last(), *_tie(tie))
    sorted_part = placed.join(crossed, "_bucket").withColumn(
        "_rank", F.col("_before") + F.row_number().over(inside)
    ).select(*df.columns, _tile_of(F.col("_rank"), F.col("_total"), tiles).alias(out))
    return labelled.unionByName(sorted_part)
