"""Cleaning rules, one edge at a time, and their invariants."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import plan_of

from medallion.plans.cleaning import clean, invariants, reconcile, row_counts, silver_type

RELAXED = settings(max_examples=12, deadline=None,
                   suppress_health_check=[HealthCheck.function_scoped_fixture])


def cleaned(spark, value, column, kind):
    df = spark.createDataFrame([(value,)], f"{column} {kind}")
    return clean(df).first()[0]


@pytest.mark.parametrize("column,kind,value,expected", [
    ("name", "string", "", None),
    ("name", "string", " ", " "),
    ("survey_date", "string", "2024-02-30", None),
    ("survey_date", "string", "2024-02-03", dt.date(2024, 2, 3)),
    ("survey_date", "bigint", 1706918400000, dt.date(2024, 2, 3)),
    ("survey_date", "double", 1706918400000.0, dt.date(2024, 2, 3)),
    ("last_verification", "string", "2024-02-03 10:11:12", dt.date(2024, 2, 3)),
    ("last_updated", "string", "2024-02-03 10:11:12", dt.datetime(2024, 2, 3, 10, 11, 12)),
    ("last_updated", "bigint", 1706955072000, dt.datetime(2024, 2, 3, 10, 11, 12)),
    ("is_eligible", "string", "True", True),
    ("is_disabled", "string", "maybe", None),
    ("quantity", "string", "12", 12),
    ("quantity", "string", "12.0", 12),
    ("quantity", "string", "a dozen", None),
    ("quantity", "string", "99999999999", None),
    ("metric_value", "bigint", 7, 7),
    ("amount", "string", "15000", 15000),
    ("amount_usd", "string", "10.50", 10.5),
    ("amount_usd", "string", "", None),
    ("age", "string", "44", "44"),
    ("payment_date", "date", dt.date(2024, 1, 1), dt.date(2024, 1, 1)),
])
def test_one_value(spark, column, kind, value, expected):
    assert cleaned(spark, value, column, kind) == expected


def test_same_rules_with_ansi_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert cleaned(spark, "a dozen", "quantity", "string") is None
        assert cleaned(spark, "12.0", "quantity", "string") == 12
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_types_follow_names():
    assert silver_type("anything_date") == "date"
    assert silver_type("last_verification") == "date"
    assert silver_type("reorder_level") == "int"
    assert silver_type("date_of_birth") is None


def test_blank_and_null_twins_are_one_row(spark):
    df = spark.createDataFrame([("a", ""), ("a", None), ("a", "")], "k string, v string")
    assert [tuple(r) for r in clean(df).collect()] == [("a", None)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, survey_date bigint")
    assert clean(df).count() == 0
    assert clean(df).schema["survey_date"].dataType.simpleString() == "date"


texts = st.one_of(st.none(), st.just(""), st.text("abc", max_size=3))


@pytest.mark.property
@RELAXED
@given(st.lists(st.tuples(texts, texts, texts), min_size=1, max_size=40), st.integers(1, 5))
def test_no_copies_no_blanks_no_growth(spark, rows, copies):
    df = spark.createDataFrame([*rows, *rows[:copies]], "col_a string, col_b string, col_c string")
    row = invariants(df, clean(df)).first()
    distinct = {tuple(v or None for v in r) for r in rows}
    assert row.rows_before == len(rows) + len(rows[:copies])
    assert row.rows_after == len(distinct)
    assert (row.duplicate_rows, row.blank_strings, row.no_growth) == (0, 0, True)


def test_invariants_see_violations(spark):
    before = spark.createDataFrame([("a",)], "v string")
    after = spark.createDataFrame([("a",), ("a",), ("",)], "v string")
    row = invariants(before, after).first()
    assert (row.duplicate_rows, row.blank_strings, row.no_growth) == (1, 1, False)


def test_reconciliation(spark):
    bronze = {"t": spark.range(3).union(spark.range(3)), "u": spark.range(4)}
    silver = {n: clean(df) for n, df in bronze.items()}
    got = {r.table_name: tuple(r)[1:] for r in
           reconcile(row_counts(bronze), row_counts(silver)).collect()}
    assert got == {"t": (6, 3, 3, 50.0), "u": (4, 4, 0, 0.0)}


def test_copies_collapse_before_the_shuffle(spark):
    plan = plan_of(clean(spark.createDataFrame([("a", "1")], "k string, quantity string")))
    assert plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2
