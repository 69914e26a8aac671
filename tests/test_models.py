"""Model edges: NULL keys, zero commitments, ties, gaps, skew."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medallion.plans import intermediate, kpis, marts, quality
from medallion.plans.staging import stg_donor_reports
from medallion.specs import MODELS

D = dt.date
RELAXED = settings(max_examples=8, deadline=None,
                   suppress_health_check=[HealthCheck.function_scoped_fixture])

PAY = "payment_id string, beneficiary_id string, payment_status string, payment_date date, amount long"
BEN = "beneficiary_key string, district string, program string"


def payments(spark, *rows):
    return spark.createDataFrame([(f"p{i}", *r, 1) for i, r in enumerate(rows)], PAY)


def test_payments_without_a_beneficiary_keep_their_own_group(spark):
    pay = payments(spark, (None, "Success", D(2024, 1, 5)), ("x", "Failed", D(2024, 1, 9)),
                   ("b", "Success", D(2024, 1, 31)))
    ben = spark.createDataFrame([("b", "D", "P")], BEN)
    rows = {r.district: r for r in marts.mart_payment_kpis(pay, ben).collect()}
    assert rows[None].total_payments == 2 and rows[None].success_rate == 0.5
    assert rows["D"].total_payments == 1 and rows["D"].reporting_month == D(2024, 1, 1)


def test_rolling_mean_spans_three_rows_not_three_months(spark):
    months = [D(2024, 1, 1), D(2024, 2, 1), D(2024, 7, 1), D(2024, 8, 1)]
    pay = payments(spark, *[("b", "Success" if m.month != 2 else "Failed", m) for m in months])
    ben = spark.createDataFrame([("b", "D", "P")], BEN)
    rows = marts.mart_payment_kpis(pay, ben).orderBy("reporting_month").collect()
    assert [r.rolling_3m_avg_success_rate for r in rows] == pytest.approx([1, 1/2, 2/3, 2/3])


def test_null_status_is_neither_success_nor_open(spark):
    pay = payments(spark, ("b", None, D(2024, 1, 1)))
    ben = spark.createDataFrame([("b", "D", "P")], BEN)
    assert marts.mart_payment_kpis(pay, ben).first().successful_payments == 0
    cases = spark.createDataFrame(
        [("t", "High", "d", D(2024, 1, 1), None), ("t", "High", "d", D(2024, 1, 2), "Open")],
        "incident_type string, risk_level string, host_district string, "
        "incident_date date, case_status string")
    row = marts.mart_protection_caseload(cases).first()
    assert (row.open_cases, row.total_cases) == (1, 2)


def test_duplicate_dimension_keys_fan_out_like_a_row_join(spark):
    pay = payments(spark, ("b", "Success", D(2024, 1, 1)), ("b", "Failed", D(2024, 1, 2)))
    ben = spark.createDataFrame([("b", "D1", "P"), ("b", "D1", "P"), ("b", "D2", "P")], BEN)
    rows = {r.district: (r.total_payments, r.successful_payments)
            for r in marts.mart_payment_kpis(pay, ben).collect()}
    assert rows == {"D1": (4, 2), "D2": (2, 1)}


def test_null_disbursement_counts_as_fully_spent(spark):
    silver = spark.createDataFrame(
        [("r1", 100.0, None), ("r2", 100.0, 250.0), ("r3", 100.0, 40.0)],
        "report_id string, amount_committed double, amount_disbursed double")
    for c in MODELS["stg_donor_reports"].columns:
        if c not in silver.columns:
            silver = silver.selectExpr("*", f"cast(null as string) as {c}")
    got = {r.report_id: r.amount_disbursed for r in stg_donor_reports(silver).collect()}
    assert got == {"r1": 100.0, "r2": 100.0, "r3": 40.0}


DONOR = ("report_id string, donor string, program string, amount_committed double, "
         "amount_disbursed double, disbursement_date date")


def test_zero_commitment_has_no_utilisation_and_ranks_last(spark):
    reports = spark.createDataFrame(
        [("1", "A", "P", 0.0, 0.0, None), ("2", "B", "P", 10.0, 5.0, None),
         ("3", "C", "P", 20.0, 10.0, None), ("4", "D", "P", 10.0, 1.0, None)], DONOR)
    mart = marts.mart_donor_budget_vs_actual(
        intermediate.int_donor_program_aggregates(reports))
    got = {r.donor: (r.utilization_pct, r.utilization_rank) for r in mart.collect()}
    assert got == {"B": (50.0, 1), "C": (50.0, 1), "D": (10.0, 3), "A": (None, 4)}


def test_assistance_summary_edges(spark):
    refugees = spark.createDataFrame(
        [("f1", 4.0), ("f2", None), ("f3", 8.0), ("f3", 6.0)],
        "refugee_id string, vulnerability_score double")
    help_ = spark.createDataFrame(
        [("f1", 10.0), ("f1", None), ("f2", 5.0), ("f3", 1.0), ("none", 2.0), (None, 3.0)],
        "refugee_id string, amount_usd double",
    ).selectExpr("*", "'P' as program", "'M' as modality", "'H' as host_district")
    row = marts.mart_refugee_assistance_summary(refugees, help_).first()
    # f3 has two refugee rows, so its delivery joins twice
    assert row.delivery_count == 7
    assert row.total_beneficiaries == 4
    assert row.total_amount_usd == 22.0
    assert row.avg_amount_usd == 22.0 / 7          # the missing amount counts as zero
    assert row.avg_vulnerability_score == (4 + 4 + 8 + 6) / 4


def test_beneficiary_without_payments(spark):
    ben = spark.createDataFrame([("b",)], "beneficiary_key string")
    for c in MODELS["int_beneficiaries_payments"].columns:
        if c not in ben.columns:
            ben = ben.selectExpr("*", f"cast(null as string) as {c}")
    row = intermediate.int_beneficiaries_payments(ben, payments(spark)).first()
    assert (row.total_payments, row.total_amount, row.last_payment_date) == (0, 0, None)


def test_negative_resolution_days_are_averaged(spark):
    complaints = spark.createDataFrame(
        [("d", "c", "Resolved", D(2024, 1, 10), D(2024, 1, 6)),
         ("d", "c", "Resolved", D(2024, 1, 10), D(2024, 1, 20)),
         ("d", "c", "Resolved", D(2024, 1, 10), None),
         ("d", "c", "Open", D(2024, 1, 10), D(2024, 3, 1)),
         ("d", "x", "Open", D(2024, 1, 10), None)],
        "district string, category string, status string, complaint_date date, "
        "resolution_date date")
    rows = {r.category: r for r in kpis.complaint_resolution(complaints).collect()}
    assert rows["c"].total_complaints == 4 and rows["c"].resolved_complaints == 3
    assert rows["c"].avg_resolution_days == 3.0
    assert rows["c"].p90_resolution_days == 8.6
    assert rows["x"].avg_resolution_days is None and rows["x"].p90_resolution_days is None


def test_critical_items_keep_copies_and_order(spark):
    items = spark.createDataFrame(
        [("A", 0, 5), ("A!", 0, 5), ("A", 0, 5), ("Z", 9, 5), (None, 0, 5)],
        "item_name string, quantity int, reorder_level int",
    ).selectExpr("*", "'w' as warehouse", "cast(null as string) as program", "'t' as item_type")
    row = kpis.inventory_reorder_alerts(items).first()
    assert row.critical_items == "A, A, A!"
    assert (row.total_items, row.items_below_reorder, row.alert_pct) == (5, 4, 0.8)


def test_no_critical_items_is_null(spark):
    items = spark.createDataFrame([("A", 7, 5)], "item_name string, quantity int, reorder_level int"
                                  ).selectExpr("*", "'w' warehouse", "'p' program", "'t' item_type")
    assert kpis.inventory_reorder_alerts(items).first().critical_items is None


@pytest.mark.property
@RELAXED
@given(st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from("PQ"),
                          st.floats(1, 1e8), st.floats(0, 1e8)), min_size=1, max_size=40))
def test_utilisation_identity(spark, rows):
    df = spark.createDataFrame(
        [(str(i), d, p, c, x, None) for i, (d, p, c, x) in enumerate(rows)], DONOR)
    for r in intermediate.int_donor_program_aggregates(df).collect():
        mine = [x for x in rows if (x[0], x[1]) == (r.donor, r.program)]
        committed, spent = sum(x[2] for x in mine), sum(x[3] for x in mine)
        assert r.total_committed == pytest.approx(committed)
        assert r.utilization_pct == pytest.approx(spent / committed * 100, abs=1e-3)


@pytest.mark.property
@RELAXED
@given(st.lists(st.tuples(st.sampled_from(["t", "u"]), st.sampled_from(["High", "Low"]),
                          st.dates(D(2024, 1, 1), D(2024, 4, 1))), min_size=1, max_size=40))
def test_cumulative_cases_only_grow(spark, rows):
    df = spark.createDataFrame(
        [(t, r, "d", day, "Open") for t, r, day in rows],
        "incident_type string, risk_level string, host_district string, "
        "incident_date date, case_status string")
    out = kpis.protection_caseload(df).collect()
    for t in {r[0] for r in rows}:
        mine = sorted((r for r in out if r.incident_type == t),
                      key=lambda r: (r.incident_date, r.risk_level))
        totals = [r.cumulative_case_count for r in mine]
        assert totals == sorted(totals) and totals[-1] == sum(x[0] == t for x in rows)


@pytest.mark.property
@RELAXED
@given(st.lists(st.tuples(st.sampled_from(["b1", "b2", "none", None]),
                          st.sampled_from(["Success", "Failed", "Pending", None]),
                          st.dates(D(2024, 1, 1), D(2024, 6, 1))), min_size=1, max_size=40))
def test_rates_stay_between_zero_and_one(spark, rows):
    ben = spark.createDataFrame([("b1", "D", "P"), ("b2", "E", "P")], BEN)
    out = kpis.payment_success_rates(payments(spark, *rows), ben).collect()
    assert sum(r.total_payments for r in out) == len(rows)
    assert all(0 <= r.success_rate <= 1 and 0 <= r.rolling_3m_avg <= 1 for r in out)


@pytest.mark.property
@RELAXED
@given(st.lists(st.one_of(st.none(), st.floats(0, 10)), min_size=20, max_size=80))
def test_deciles_are_ordered_and_even(spark, scores):
    df = spark.createDataFrame(
        [(f"f{i}", v, 3, False, True) for i, v in enumerate(scores)],
        "refugee_id string, vulnerability_score double, family_size long, "
        "has_disability boolean, is_unaccompanied_minor boolean")
    out = kpis.refugee_vulnerability(df).collect()
    assert [r.decile for r in out] == list(range(1, 11))
    sizes = [r.refugee_count for r in out]
    assert sum(sizes) == len(scores) and max(sizes) - min(sizes) <= 1
    bounds = [b for r in out for b in (r.min_vulnerability_score, r.max_vulnerability_score)
              if b is not None]
    assert bounds == sorted(bounds)
    assert out[0].disability_rate == 0 and out[0].unaccompanied_minor_rate == 1


def test_invariants_hold_on_the_test_tables(inputs):
    from workload.queries import KPI_KEYS
    assert all(r.violations == 0 for r in KPI_KEYS["kpi_invariants"](inputs).collect())


def test_model_outputs_match_their_declared_columns(inputs):
    for name, spec in MODELS.items():
        assert tuple(inputs.models[name].columns) == spec.columns, name


def test_declared_contracts():
    assert quality.primary_keys_covered() == []
    assert quality.undocumented_columns() == []
    assert sum(len(s.not_null) for s in MODELS.values()) == 50
    assert sum(len(s.unique) for s in MODELS.values()) == 11
    assert sum(len(s.accepted) for s in MODELS.values()) == 6
