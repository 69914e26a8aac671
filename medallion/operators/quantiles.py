"""Exact quantiles per group by distributed selection.

``percentile`` keeps every distinct value of a group in one task.  Here the wanted ranks are
found by counting: a group's rows are cut at approximate quantiles, the pieces are counted,
and only the pieces that hold a wanted rank are looked at again, until each is small or one
value.  What is left, at most ``piece_rows`` rows per wanted rank, is ranked by a window.
The cut points decide how fast pieces shrink, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.operators.enrich import join_null_safe
from medallion.session import settle


def _numbers(values: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def _wanted(sizes: DataFrame, groups: list[str], shares: Sequence[float]) -> DataFrame:
    """One row per group and rank to look up: the two ranks around each share."""
    at = F.col("_share") * (F.col("_n") - 1)
    spread = sizes.select(*groups, "_n", F.explode(_numbers(shares)).alias("_share"))
    return spread.select(*groups, F.explode(F.array_distinct(F.array(
        F.floor(at), F.ceil(at)))).alias("_rank")).distinct()


def _pieces(inside: DataFrame, cells: list[str], cuts: int) -> DataFrame:
    """``inside`` with ``_piece``, which rises with the value; equal values share a piece."""
    shares = _numbers([i / cuts for i in range(1, cuts)])
    points = inside.groupBy(*cells).agg(
        F.percentile_approx("_v", shares, F.lit(cuts * 8)).alias("_cuts"))
    joined = join_null_safe(inside, points, cells)
    # a value equal to a cut has a piece of its own: 2 k for the k-th cut, odd in between
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    cut = F.array_contains("_cuts", F.col("_v"))
    return joined.withColumn("_piece", below * 2 + F.when(cut, 0).otherwise(-1)).drop("_cuts")


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, shares: Sequence[float],
                    out: str = "quantiles", piece_rows: int = 1_000_000,
                    cuts: int = 64, rounds: int = 40) -> DataFrame:
    """``groups``, ``n`` values and the array ``out`` of the quantiles at ``shares``.

    Linear interpolation between neighbouring ranks, as PERCENTILE_CONT.  NULLs do not
    count; NaN is the largest value; a group without values has NULLs.  Runs jobs: one
    count, and two for each round in which some piece is larger than ``piece_rows``.
    """
    groups = list(groups)
    rows = df.select(*groups, F.col(value).cast("double").alias("_v"))
    sizes = settle(rows.groupBy(*groups).agg(
        F.count("_v").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")),
        "group-sizes")
    # state: a wanted rank, the closed range of values that holds it, rows below and in it
    wanted = _wanted(sizes.where("_n > 0"), groups, shares)
    state = settle(join_null_safe(wanted, sizes, groups).select(
        *groups, "_rank", "_low", "_high",
        F.lit(0).cast("bigint").alias("_below"), F.col("_n").alias("_rows")), "wanted-ranks")
    cells = [*groups, "_low", "_high"]
    large = (F.col("_rows") > piece_rows) & (F.col("_low") < F.col("_high"))
    for _ in range(rounds):
        if state.where(large).isEmpty():
            break
        state = settle(_refined(rows, state, groups, cells, large, cuts), "wanted-ranks")
    return _looked_up(rows, state, sizes, groups, cells, shares, out)


def _inside(rows: DataFrame, state: DataFrame, groups: list[str], cells: list[str]) -> DataFrame:
    """Rows that lie in a range of ``state``, with the range."""
    ranges = state.select(*cells).distinct()
    near = join_null_safe(rows, ranges, groups)
    return near.where(F.col("_v").between(F.col("_low"), F.col("_high"))).select(*cells, "_v")


def _refined(rows: DataFrame, state: DataFrame, groups: list[str], cells: list[str],
             large: Column, cuts: int) -> DataFrame:
    """The state after cutting its large ranges once more."""
    placed = _pieces(_inside(rows, state.where(large), groups, cells), cells, cuts)
    counts = placed.groupBy(*cells, "_piece").agg(
        F.count(F.lit(1)).alias("_in"), F.min("_v").alias("_first"), F.max("_v").alias("_last"))
    before = F.sum("_in").over(  # at most 2 * cuts rows per range
        Window.partitionBy(*cells).orderBy("_piece")) - F.col("_in")
    counts = counts.withColumn("_before", before)
    both = join_null_safe(state.where(large), counts, cells)
    rank = F.col("_rank") - F.col("_below") - F.col("_before")
    new = both.where((rank >= 0) & (rank < F.col("_in"))).select(
        *groups, "_rank", F.col("_first").alias("_low"), F.col("_last").alias("_high"),
        (F.col("_below") + F.col("_before")).alias("_below"), F.col("_in").alias("_rows"))
    return state.where(~large).unionByName(new)


def _looked_up(rows: DataFrame, state: DataFrame, sizes: DataFrame, groups: list[str],
               cells: list[str], shares: Sequence[float], out: str) -> DataFrame:
    single = F.col("_low") == F.col("_high")
    some = state.where(~single)
    ranked = _inside(rows, some, groups, cells).withColumn(
        "_at", F.row_number().over(Window.partitionBy(*cells).orderBy("_v")) - 1)
    found = join_null_safe(some, ranked, cells).where(
        F.col("_rank") == F.col("_below") + F.col("_at")).select(*groups, "_rank", "_v")
    known = state.where(single).select(*groups, "_rank", F.col("_low").alias("_v"))
    values = known.unionByName(found).groupBy(*groups).agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_map"))

    def at(share: Column) -> Column:
        place = share * (F.col("_n") - 1)
        low, high = (F.element_at("_map", f(place)) for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))

    joined = join_null_safe(sizes, values, groups, "left")
    return joined.select(*groups, F.col("_n").alias("n"),
                         F.transform(_numbers(shares), at).alias(out))
