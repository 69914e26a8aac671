"""Scalar helpers and order-independent sums."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion import functions as fn


def one(spark, expr, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(expr.alias("x")).first().x


def test_safe_ratio(spark):
    assert one(spark, fn.safe_ratio("a", "b"), a=1, b=4) == 0.25
    assert one(spark, fn.safe_ratio("a", "b", 100), a=1, b=4) == 25.0
    assert one(spark, fn.safe_ratio("a", "b"), a=1, b=0) is None
    assert one(spark, fn.safe_ratio("a", "b"), a=1.5, b=0.0) is None


def test_round_is_half_away_from_zero_on_the_scaled_value(spark):
    assert one(spark, fn.round_n("a", 2), a=0.125) == 0.13
    assert one(spark, fn.round_n("a", 2), a=-0.125) == -0.13
    assert one(spark, fn.round_n("a", 4), a=2 / 3) == 0.6667


def test_dates(spark):
    a, b = dt.date(2024, 3, 1), dt.date(2024, 2, 28)
    assert one(spark, fn.days_between("a", "b"), a=a, b=b) == -2
    assert one(spark, fn.month_of("a"), a=dt.date(2024, 3, 17)) == a
    assert one(spark, fn.epoch_ms_to_date("a"), a=-1) == dt.date(1969, 12, 31)
    assert one(spark, fn.epoch_ms_to_date("a"), a=1704067199999) == dt.date(2023, 12, 31)


def test_epoch_days_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert one(spark, fn.epoch_ms_to_date("a"), a=1704067200000) == dt.date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_percent_text_rounds_ties_to_even_like_the_charts(spark):
    for v in (0.125, 0.135, 0.873, 1.0, 0.005):
        assert one(spark, fn.percent_text("a"), a=v) == f"{v:.0%}"


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=50))
def test_exact_sum_is_exact_for_cents(spark, cents):
    values = [c / 100 for c in cents]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    total = float(sum(Decimal(c) for c in cents) / 100)
    row = df.agg(fn.exact_sum("v").alias("s"), fn.exact_avg("v").alias("a")).first()
    assert row.s == total
    assert row.a == total / len(values)


def test_exact_sum_edges(spark):
    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(fn.exact_sum("v").alias("s")).first().s
    assert total([]) is None
    assert total([None, None]) is None
    assert total([None, 1.5]) == 1.5
    assert total([0.1] * 10) == 1.0
    assert math.isnan(total([1.0, math.nan]))
    assert total([1.0, math.inf]) == math.inf
    assert total([1e300, 2.0]) == 1e300


def test_exact_sum_keeps_small_and_large_values(spark):
    def total(value, n):
        df = spark.range(n).repartition(3).select(F.lit(value).alias("v"))
        return df.agg(fn.exact_sum("v").alias("s")).first().s
    assert total(1e-7, 1000) == pytest.approx(1e-4, rel=1e-12)
    assert total(1 / 3, 3) == pytest.approx(1.0, rel=1e-15)
    assert total(8e15, 3000) == 2.4e19
    assert total(-8e15 - 0.5, 3000) == -3000 * (8e15 + 0.5)
    assert total(9e17, 1000) == 9e20


def test_epoch_numbers_out_of_range_are_null(spark):
    for value in (math.nan, 1e30, -1e30, math.inf, 9e18):
        assert one(spark, fn.epoch_ms_to_date("a"), a=value) is None
        assert one(spark, fn.epoch_ms_to_timestamp("a"), a=value) is None
    assert one(spark, fn.epoch_ms_to_date("a"), a=9 * 10 ** 18) is None
    assert one(spark, fn.epoch_ms_to_timestamp("a"), a=9 * 10 ** 18) is None
