"""Plan properties that must hold for the plans to work on large tables."""

from __future__ import annotations

import re

import pytest
from plans import plan_of

from medallion.plans import history, kpis
from medallion.plans.gold import Models
from medallion.plans.staging import STAGING


@pytest.fixture(scope="module")
def models(spark, inputs, tmp_path_factory):
    """Models over silver tables on disk, with automatic broadcast off, as if large."""
    folder = str(tmp_path_factory.mktemp("silver"))
    for name in STAGING:
        inputs.entity(name).write.parquet(f"{folder}/{name}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Models(lambda n: spark.read.parquet(f"{folder}/{n}"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


MARTS = ["int_beneficiaries_payments", "int_refugees_assistance",
         "int_donor_program_aggregates", "mart_payment_kpis", "mart_donor_budget_vs_actual",
         "mart_refugee_assistance_summary", "mart_survey_metric_trends"]


def columns_read(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


@pytest.mark.parametrize("name", MARTS)
def test_no_single_task_and_no_python(models, name):
    plan = plan_of(models[name])
    assert "SinglePartition" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", MARTS)
def test_facts_are_aggregated_before_their_first_shuffle(models, name):
    plan = plan_of(models[name])
    fact = {"int_beneficiaries_payments": "payment_date", "int_refugees_assistance": "delivery_date",
            "int_donor_program_aggregates": "amount_committed", "mart_payment_kpis": "payment_status",
            "mart_donor_budget_vs_actual": "amount_committed",
            "mart_refugee_assistance_summary": "amount_usd",
            "mart_survey_metric_trends": "metric_value"}[name]
    lines = plan.splitlines()
    scan = next(i for i, s in enumerate(lines) if "FileScan" in s and fact in s)
    above = [s for s in reversed(lines[:scan])]
    first = next(s for s in above if "Exchange" in s or "HashAggregate" in s)
    assert "HashAggregate" in first and "partial" in first


@pytest.mark.parametrize("name,expected", [
    ("mart_payment_kpis", [{"beneficiary_id", "payment_date", "payment_status"},
                           {"beneficiary_id", "district", "program"}]),
    ("mart_refugee_assistance_summary",
     [{"refugee_id", "program", "modality", "amount_usd", "host_district"},
      {"refugee_id", "vulnerability_score"}]),
])
def test_scans_read_only_what_the_mart_needs(models, name, expected):
    assert columns_read(plan_of(models[name])) == expected


def test_running_totals_scan_the_facts_once(spark, models):
    df = models["mart_protection_caseload"]
    plan = plan_of(df)
    assert "case_status" not in plan  # both halves read the stored aggregate
    assert "SinglePartition" not in plan


def test_percentile_works_on_counted_days(models):
    plan = plan_of(kpis.complaint_resolution(models["stg_complaints"]))
    below = plan[plan.index("partial_percentile"):]
    assert below.count("HashAggregate") >= 2 and plan.count("FileScan") == 1


def test_string_aggregate_sees_counted_names(models):
    plan = plan_of(kpis.inventory_reorder_alerts(models["stg_inventory"]))
    assert plan.count("FileScan") == 1
    assert "HashAggregate" in plan[plan.index("partial_listagg"):]


def test_rank_broadcasts_only_the_hot_key_list(models):
    plan = plan_of(history.payment_rank(models["stg_payments"]))
    for part in plan.split("BroadcastExchange")[1:]:
        assert "_hot_beneficiary_id" in part[:400]


def test_filters_reach_the_scan(spark, models):
    plan = plan_of(models["stg_payments"].where("payment_status = 'Failed'").select("payment_id"))
    assert "EqualTo(payment_status,Failed)" in plan
    assert columns_read(plan) == [{"payment_id", "payment_status"}]
