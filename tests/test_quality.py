"""Checks find what they should, and read each model once."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from medallion.plans import quality
from medallion.session import settle
from medallion.specs import MODELS, ModelSpec

SPEC = ModelSpec("m", "staging", ("k",), ("k", "s", "g"), ("k", "s"), ("k",),
                 {"s": ("a", "b"), "g": ("x",)})


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("1", "a", "x"), ("1", "z", None), ("2", "z", "y"), (None, None, "x"),
         (None, "b", "x"), ("3", "q", "x")], "k string, s string, g string")


def found(df):
    return {(r.check_type, r.column_name): r.failures for r in df.collect()}


def test_checks_count_violations(table):
    assert found(quality.not_null(table, SPEC)) == {("not_null", "k"): 2, ("not_null", "s"): 1}
    assert found(quality.unique(table, SPEC)) == {("unique", "k"): 1}
    accepted = quality.accepted_values(table, SPEC)
    assert found(accepted) == {("accepted_values", "s"): 2, ("accepted_values", "g"): 1}
    assert {r.column_name: r.failing_rows for r in accepted.collect()} == {"s": 3, "g": 1}


def test_an_empty_table_reports_every_check(table):
    empty = table.where("false")
    for check in (quality.not_null, quality.unique, quality.accepted_values):
        rows = check(empty, SPEC).collect()
        assert rows and all(r.failures == 0 for r in rows)


def test_failing_rows(table):
    def keys(check, column):
        return sorted(str(r.s) for r in quality.failing_rows(table, SPEC, check, column).collect())
    assert keys("not_null", "k") == ["None", "b"]
    assert keys("unique", "k") == ["a", "z"]
    assert keys("accepted_values", "s") == ["q", "z", "z"]
    with pytest.raises(ValueError, match="unknown check"):
        quality.failing_rows(table, SPEC, "positive", "k")


def test_singular_checks(spark):
    donors = spark.createDataFrame(
        [("a", "p", 100.0, 100.01), ("b", "p", 100.0, 100.02), ("c", "p", None, 5.0)],
        "donor string, program string, total_committed double, total_disbursed double")
    assert [r.donor for r in quality.disbursed_over_committed(donors).collect()] == ["b"]
    pay = spark.createDataFrame(
        [("1", "x", 0, None), ("2", "x", 1, None), ("3", "x", None, None)],
        "payment_id string, beneficiary_id string, amount long, payment_date date")
    assert [r.payment_id for r in quality.amount_not_positive(pay).collect()] == ["1"]


def test_report_verdicts(inputs):
    names = ["stg_payments", "stg_donor_reports", "mart_donor_budget_vs_actual"]
    rows = quality.report({n: inputs.models[n] for n in names}).collect()
    by = {(r.check_type, r.model, r.column_name): r for r in rows}
    assert by["not_null", "stg_payments", "beneficiary_id"].should_error
    assert not by["unique", "stg_payments", "payment_id"].should_error
    assert by["singular", "stg_payments", "amount_positive"].failures == 0
    assert ("singular", "mart_donor_budget_vs_actual", "disbursed_lte_committed") in by


@pytest.mark.parametrize("newest,status", [
    ("2024-01-09 12:00:00", "pass"), ("2024-01-09 00:00:00", "pass"),
    ("2024-01-08 23:00:00", "warn"), ("2024-01-08 00:00:00", "warn"),
    ("2024-01-07 23:59:59", "error"), (None, "error")])
def test_freshness_limits(spark, newest, status):
    df = spark.createDataFrame([(newest,), (None,)], "t string").selectExpr(
        "cast(t as timestamp) as t")
    row = quality.freshness({"x": (df, "t")}, dt.datetime(2024, 1, 10)).first()
    assert row.status == status


def test_one_scan_for_all_not_null_checks(spark, table, tmp_path):
    path = str(tmp_path / "t")
    table.write.parquet(path)
    plan = plan_of(quality.not_null(spark.read.parquet(path), SPEC))
    assert plan.count("FileScan") == 1
    assert "k:string,s:string" in plan and "g:string" not in plan


def test_all_column_checks_are_one_scan_per_model_and_one_exchange(spark, inputs):
    names = ["stg_payments", "stg_complaints", "stg_surveys"]
    models = {n: settle(inputs.models[n]) for n in names}
    plan = plan_of(quality.column_checks(models))
    assert plan.count("FileScan parquet") == len(names)
    assert len(re.findall(r"Exchange hashpartitioning\(check#\d+, value#\d+", plan)) == 1
    counted = {tuple(r[:3]): r["failures"] for r in quality.column_checks(models).collect()}
    for name in names:
        for kind, column in quality.declared(MODELS[name]):
            values = models[name].select(F.col(column).cast("string").alias("v"))
            if kind == "not_null":
                want = values.where("v is null").count()
            elif kind == "unique":
                want = values.where("v is not null").groupBy("v").count().where("count > 1").count()
            else:
                want = values.where(~F.col("v").isin(list(MODELS[name].accepted[column]))
                                    ).distinct().count()
            assert counted[kind, name, column] == want


def test_column_checks_of_empty_models(spark, inputs):
    empty = {n: inputs.models[n].where("false") for n in ("stg_payments", "stg_complaints")}
    rows = quality.column_checks(empty).collect()
    assert len(rows) == sum(len(quality.declared(MODELS[n])) for n in empty)
    assert all(r["failures"] == r["failing_rows"] == 0 for r in rows)
