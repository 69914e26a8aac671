"""Zones, appends, buckets and footers of stored tables, and marts kept up from appends."""

from __future__ import annotations

import datetime as dt

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from medallion.plans import quality, reports, upkeep
from medallion.plans.gold import SORTED_BY, Models
from medallion.sources import footers


def months(spark, n=3000):
    return spark.range(n).select(
        "id", F.add_months(F.lit("2020-01-01").cast("date"), (F.col("id") % 50).cast("int"))
        .alias("month"), F.when(F.col("id") % 10 > 0, F.col("id") % 5).alias("x"))


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_a_range_opens_only_its_files(spark, lake):
    rows = months(spark)
    lake.write(rows, "gold", "t", sort_by="month", files=10)
    lake.append(rows.where("id < 100").withColumn("month", F.lit(None).cast("date")), "gold", "t")
    low, high = dt.date(2021, 2, 1), dt.date(2021, 5, 1)
    got = lake.read_range("gold", "t", low, high)
    assert same(got, rows.where(F.col("month").between(low, high)))
    assert 0 < len(got.inputFiles()) <= 3 < len(lake.read("gold", "t").inputFiles())
    assert same(lake.read_range("gold", "t", high=low), rows.where(F.col("month") <= low))
    assert same(lake.read_range("gold", "t"), rows)  # NULL lies in no range
    assert lake.read_range("gold", "t", dt.date(2030, 1, 1)).count() == 0
    assert lake.bounds("gold", "t").first()[:] == (dt.date(2020, 1, 1), dt.date(2024, 2, 1), 3100)


def test_tables_without_an_order_have_no_zones(spark, lake):
    lake.write(months(spark), "gold", "t")
    with pytest.raises(LookupError, match="order of a column"):
        lake.read_range("gold", "t")
    lake.write(months(spark).limit(0), "gold", "empty", sort_by="month")
    assert lake.read_range("gold", "empty", dt.date(2020, 1, 1)).count() == 0
    assert lake.bounds("gold", "empty").first()["rows"] == 0


def test_reports_from_pruned_marts(spark, lake, inputs):
    for name, column in SORTED_BY.items():
        lake.write(inputs.models[name], "gold", name, column, files=6)
    start, end = dt.date(1996, 1, 1), dt.date(1996, 3, 1)
    got = reports.payments_from(lake, start=start, end=end)
    whole = lake.read("gold", "mart_payment_kpis")
    assert same(got, reports.payments_in_scope(whole, start=start, end=end))
    assert len(got.inputFiles()) < len(whole.inputFiles())
    kind = "purchase"
    cases = reports.cases_in_scope(lake.read("gold", "mart_protection_caseload"), kind)
    newest = cases.agg(F.max("incident_month")).first()[0]
    assert same(reports.latest_cases(lake, kind), cases.where(F.col("incident_month") == newest))


def test_appends_share_folders_and_tell_what_is_new(spark, lake):
    rows = months(spark, 100)
    lake.write(rows.where("id < 60"), "silver", "t")
    second = lake.append(rows.where("id >= 60"), "silver", "t")
    assert (second.version, second.row_count, len(second.paths)) == (1, 100, 2)
    assert same(lake.read("silver", "t"), rows)
    assert same(lake.read("silver", "t", 0), rows.where("id < 60"))
    assert same(lake.added("silver", "t", 0), rows.where("id >= 60"))
    assert lake.added("silver", "t", 1).count() == 0
    lake.write(rows, "silver", "t")
    assert lake.added("silver", "t", 1) is None


def test_joins_of_buckets_need_no_exchange(spark, lake, inputs):
    tables = {"beneficiaries": "beneficiary_id", "payments": "beneficiary_id",
              "afghan_refugees": "refugee_id", "refugee_assistance": "refugee_id"}
    for name, column in tables.items():
        lake.write(inputs.entity(name), "silver", name, buckets=(column, 4))
    models = Models(lambda t: lake.read("silver", t))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("int_beneficiaries_payments", "int_refugees_assistance"):
            assert "Exchange" not in plan_of(models[name])
            assert "Exchange" in plan_of(inputs.models[name])
            assert same(models[name], inputs.models[name])
        # another session learns the layout from the version
        path = lake.snapshot("silver", "payments").paths[0]
        spark.sql(f"DROP TABLE {lake._catalog_name(path)}")
        again = Models(lambda t: lake.read("silver", t))["int_beneficiaries_payments"]
        assert "Exchange" not in plan_of(again) and same(again, models["int_beneficiaries_payments"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with pytest.raises(ValueError, match="cannot be appended"):
        lake.append(inputs.entity("payments"), "silver", "payments")
    with pytest.raises(ValueError, match="not both"):
        lake.write(inputs.entity("payments"), "silver", "p", "amount", buckets=("amount", 2))


def test_counts_and_newest_dates_come_from_footers(spark, lake, inputs):
    lake.write(inputs.entity("payments"), "silver", "payments")
    lake.append(inputs.entity("payments"), "silver", "payments")
    stored = footers.tables(lake, "silver", ["payments"])["payments"]
    newest = quality.freshness({"payments": (stored, "payment_date")}, dt.datetime(2024, 1, 1))
    plan = plan_of(newest)
    assert "PushedAggregation: [MAX(payment_date)]" in plan
    plain = quality.freshness(
        {"payments": (inputs.entity("payments"), "payment_date")}, dt.datetime(2024, 1, 1))
    assert newest.collect() == plain.collect()
    counted = stored.agg(F.count(F.lit(1)).alias("n"))
    assert "PushedAggregation: [COUNT(*)]" in plan_of(counted)
    assert counted.first()["n"] == 2 * inputs.entity("payments").count()


@pytest.mark.parametrize("mart", upkeep.KEPT)
def test_a_kept_mart_equals_a_full_build(spark, lake, inputs, mart):
    kept = upkeep.KEPT[mart]
    rows = inputs.entity(kept.fact)
    key = rows.columns[0]
    part = F.pmod(F.xxhash64(key), F.lit(3))
    for table in kept.others:
        lake.write(inputs.entity(table), "silver", table)
    lake.write(rows.where(part == 0), "silver", kept.fact)
    upkeep.keep_up(lake, mart)
    for i in (1, 2):
        lake.append(rows.where(part == i), "silver", kept.fact)
        state, made_from = upkeep.next_state(lake, mart)
        old = [f"{lake.snapshot('silver', kept.fact, i).paths[k]}/" for k in range(i)]
        assert not any(p in f for p in old for f in state.inputFiles())  # no old facts
        assert made_from[kept.fact] == i
        upkeep.keep_up(lake, mart)
    assert same(lake.read("gold", mart), inputs.models[mart])
    # nothing appended: the state stays; written anew: it is made from all rows
    upkeep.keep_up(lake, mart)
    assert same(lake.read("gold", mart), inputs.models[mart])
    lake.write(rows, "silver", kept.fact)
    upkeep.keep_up(lake, mart)
    assert same(lake.read("gold", mart), inputs.models[mart])


def test_a_changed_dimension_makes_the_state_anew(spark, lake, inputs):
    people = inputs.entity("beneficiaries")
    lake.write(people, "silver", "beneficiaries")
    lake.write(inputs.entity("payments"), "silver", "payments")
    upkeep.keep_up(lake, "mart_payment_kpis")
    moved = people.withColumn("district", F.lit("X"))
    lake.write(moved, "silver", "beneficiaries")
    upkeep.keep_up(lake, "mart_payment_kpis")
    out = lake.read("gold", "mart_payment_kpis")
    assert {r[0] for r in out.select("district").distinct().collect()} == {"X", None}
