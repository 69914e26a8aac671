"""Exact quantiles by selection, against numpy; ranks in pieces; mergeable distinct counts."""

from __future__ import annotations

import random

import numpy as np
import pytest
from plans import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from medallion.operators import (
    distinct_counts,
    distinct_state,
    exact_quantiles,
    merge_states,
    number_values,
    rank_rows,
)

SHARES = (0.0, 0.1, 0.5, 0.9, 1.0)


@pytest.mark.parametrize("piece_rows", [1, 50, 1_000_000])
def test_quantiles_of_skewed_groups(spark, piece_rows):
    rng = random.Random(piece_rows)
    values = {"hot": [rng.choice([5.0, rng.gauss(0, 1), 1e12]) for _ in range(4000)],
              "ties": [3.0] * 600 + [4.0], "one": [7.5], "two": [1.0, 2.0],
              "wide": [rng.random() * 10.0 ** rng.randrange(-200, 200) for _ in range(900)],
              None: [float(i) for i in range(200)], "none": [None, None]}
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("hot", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(
        df, ["g"], "v", SHARES, "q", piece_rows=piece_rows, cuts=8).collect()}
    assert set(got) == set(values)
    for g, vs in values.items():
        real = [v for v in vs if v is not None]
        assert got[g][0] == len(real)
        if real:
            assert got[g][1] == pytest.approx(list(np.quantile(real, SHARES)), rel=1e-12)
        else:
            assert got[g][1] == [None] * len(SHARES)


def test_quantiles_over_everything_and_nothing(spark):
    df = spark.range(101).select(F.col("id").alias("v"))
    assert exact_quantiles(df, [], "v", [0.25]).first()[:] == (101, [25.0])
    assert exact_quantiles(df.where("v < 0"), [], "v", [0.25]).first()[:] == (0, [None])


def test_no_percentile_over_raw_values(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    assert "percentile(" not in plan_of(exact_quantiles(df, ["g"], "v", SHARES, piece_rows=10))


def _ranked(df, out):
    return sorted(map(str, out.select("id", "k", "v", "place").collect()))


def test_rank_in_a_hot_key_with_ties(spark):
    df = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 5 == 0, 42.0).when(
            F.col("id") % 13 == 0, float("nan")).otherwise(
            (F.col("id") * 7919 % 997).cast("double")).alias("v"))
    plain = df.withColumn("place", F.rank().over(
        Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    for cuts in (1, 5, 127):
        assert _ranked(df, rank_rows(df, ["k"], "v", "place", cuts=cuts)) == _ranked(df, plain)
    assert rank_rows(df.limit(0), ["k"], "v", "place").count() == 0


def test_no_piece_of_a_hot_key_is_large(spark):
    """One key in a third of the rows: the windows that rank it see few rows each."""
    df = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("k"), F.col("id") % 400)).alias("k"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise((F.col("id") % 9973).cast("double"))
        .alias("v")).repartition(16)
    plan = rank_rows(df, ["k"], "v", "place", cuts=63)
    assert "_piece" in plan_of(plan) and "_lane" in plan_of(plan)
    # as the operator deals the hot key: distinct values between two cuts, ties in lanes
    hot = df.where("k = 'hot' and v <> 1.0")
    cuts = hot.agg(F.percentile_approx("v", [i / 64 for i in range(1, 64)], 504)).first()[0]
    piece = F.size(F.filter(F.lit(cuts), lambda c: c > F.col("v")))
    assert hot.groupBy(piece).count().agg(F.max("count")).first()[0] < 10_000 / 16
    assert plan.where("k = 'hot'").agg(F.max("place")).first()[0] > 4000


def test_distinct_counts_merge_over_groups_and_batches(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("v"), (F.col("id") * 37 % 900)).alias("value"),
        (F.col("id") % 7).alias("district"), F.when(F.col("id") % 3 > 0, F.col("id") % 3)
        .alias("program"))
    df = df.withColumn("value", F.when(F.col("value") != "v7", F.col("value")))
    first, second = df.where("district < 4"), df.where("district >= 4")
    numbers = number_values(first, "value")
    more = number_values(second, "value", numbers)
    assert more.select("number").distinct().count() == more.count() == 899
    assert more.join(numbers, ["value", "number"]).count() == numbers.count()
    groups = ["district", "program"]
    both = merge_states(
        distinct_state(first, groups, "value", numbers).unionByName(
            distinct_state(second, groups, "value", more)), groups)
    for by in (groups, ["district"], ["program"], []):
        want = df.groupBy(*by).agg(F.count_distinct("value").alias("n"))
        assert sorted(map(str, distinct_counts(both, by, "n").collect())) == sorted(
            map(str, want.collect()))
