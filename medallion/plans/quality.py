"""Data-quality checks.  A check passes when it counts no violations.

All checks on columns, of any number of models, are one pass: each model is scanned once,
and the values that matter to a check are counted together in one exchange.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.specs import MODELS, ModelSpec

REPORT = ("check_type", "model", "column_name", "failures")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _row(kind: str, model: str, column: Column, failures: Column) -> list[Column]:
    return [F.lit(kind).alias("check_type"), F.lit(model).alias("model"),
            column.alias("column_name"), failures.cast("bigint").alias("failures")]


KINDS = ("not_null", "unique", "accepted_values")


def declared(spec: ModelSpec, kinds: Sequence[str] = KINDS) -> list[tuple[str, str]]:
    """The checks of a model as (kind, column)."""
    columns = {"not_null": spec.not_null, "unique": spec.unique,
               "accepted_values": list(spec.accepted)}
    return [(k, c) for k in KINDS if k in kinds for c in columns[k]]


def _asked(df: DataFrame, spec: ModelSpec, checks: list[tuple[str, str]],
           number: Mapping[tuple[str, str, str], int]) -> DataFrame:
    """The values that matter to the checks of one model, as ``check`` and ``value``: NULLs
    of not-null columns, all values of unique ones, and values outside the accepted ones."""
    def one(kind: str, column: str) -> Column:
        value = F.col(column).cast("string")
        if kind == "not_null":
            value = F.when(F.col(column).isNull(), "")
        elif kind == "accepted_values":
            value = F.when(~value.isin(list(spec.accepted[column])), value)
        return value.alias(str(number[kind, spec.name, column]))

    values = [one(k, c) for k, c in checks]
    names = [str(number[k, spec.name, c]) for k, c in checks]
    return df.select(*values).unpivot([], names, "check", "value").where("value is not null")


def column_checks(models: Mapping[str, DataFrame],
                  kinds: Sequence[str] = KINDS,
                  specs: Mapping[str, ModelSpec] = MODELS) -> DataFrame:
    """All declared checks of all models, each model scanned once and all values counted in
    one exchange: ``check_type``, ``model``, ``column_name``, ``failures``, ``failing_rows``.

    A failure is a NULL, a value that occurs more than once, or a distinct value outside
    the list.  Values are counted per check, map-side first, so a value held by very many
    rows is a row per task.
    """
    listed = [(k, name, c) for name in models for k, c in declared(specs[name], kinds)]
    number = {check: i for i, check in enumerate(listed)}
    frames = [_asked(df, specs[name], checks, number) for name, df in models.items()
              if (checks := declared(specs[name], kinds))]
    counted = _union(frames).groupBy("check", "value").agg(F.count(F.lit(1)).alias("_n"))
    names = F.array(*(F.struct(F.lit(str(i)).alias("check"), *(
        F.lit(x).alias(n) for n, x in zip(REPORT, check)))
        for check, i in number.items()))
    repeated = F.count_if(F.col("_n") > 1)
    per_check = counted.groupBy("check").agg(
        F.count(F.lit(1)).alias("_values"), F.sum("_n").alias("_rows"),
        repeated.alias("_repeated"), F.coalesce(
            F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("_copies"))
    # one row per declared check, so that an empty table still reports it
    spark = next(iter(models.values())).sparkSession
    wanted = spark.range(1).select(F.inline(names))
    kind = F.col("check_type")
    failures = F.when(kind == "not_null", F.col("_rows")).when(
        kind == "unique", F.col("_repeated")).otherwise(F.col("_values"))
    failing = F.when(kind == "unique", F.col("_copies")).otherwise(F.col("_rows"))
    return wanted.join(per_check, "check", "left").select(
        *REPORT[:3], F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
        F.coalesce(failing, F.lit(0)).cast("bigint").alias("failing_rows"))


def not_null(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """NULLs per declared column, one scan for the model."""
    return column_checks({spec.name: df}, ["not_null"], {spec.name: spec}).select(*REPORT)


def unique(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Number of values that occur more than once; NULL is not a value."""
    return column_checks({spec.name: df}, ["unique"], {spec.name: spec}).select(*REPORT)


def accepted_values(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Distinct values outside the declared list (``failures``) and the rows holding
    them (``failing_rows``); NULL passes."""
    return column_checks({spec.name: df}, ["accepted_values"], {spec.name: spec})


def disbursed_over_committed(donor_mart: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Donor rows whose disbursement exceeds the commitment by more than the tolerance."""
    return donor_mart.where(
        F.col("total_disbursed") > F.col("total_committed") + tolerance
    ).select("donor", "program", "total_committed", "total_disbursed")


def amount_not_positive(payments: DataFrame) -> DataFrame:
    """Payments of zero or less."""
    return payments.where(F.col("amount") <= 0).select(
        "payment_id", "beneficiary_id", "amount", "payment_date")


def _singular(kind: str, model: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("_n")).select(
        *_row("singular", model, F.lit(kind), F.col("_n")))


def report(models: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared check of the given models, with its verdict."""
    frames = [column_checks(models).select(*REPORT)]
    if "mart_donor_budget_vs_actual" in models:
        frames.append(_singular(
            "disbursed_lte_committed", "mart_donor_budget_vs_actual",
            disbursed_over_committed(models["mart_donor_budget_vs_actual"])))
    if "stg_payments" in models:
        frames.append(_singular(
            "amount_positive", "stg_payments", amount_not_positive(models["stg_payments"])))
    failed = F.col("failures") != 0
    return _union(frames).select(
        *REPORT, failed.alias("should_warn"), failed.alias("should_error"))


def failing_rows(df: DataFrame, spec: ModelSpec, check: str, column: str) -> DataFrame:
    """The rows behind a failed check."""
    if check == "not_null":
        return df.where(F.col(column).isNull())
    if check == "accepted_values":
        return df.where(~F.col(column).isin(list(spec.accepted[column])))
    if check == "unique":
        repeated = (df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
                    .where("_n > 1").select(F.col(column).alias("_repeated")))
        return df.join(repeated, F.col(column) == F.col("_repeated"), "left_semi")
    raise ValueError(f"unknown check {check!r}; known: accepted_values, not_null, unique")


def freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of: dt.datetime,
              warn_hours: float = 24, error_hours: float = 48) -> DataFrame:
    """Age of each table's newest row at ``as_of`` (UTC) against the two limits.

    Over ``footers.tables`` the newest date comes from the files' footers.
    """
    moment = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")

    def one(name: str, df: DataFrame, column: str) -> DataFrame:
        newest = df.agg(F.max(F.col(column)).cast("timestamp").alias("_newest"))
        hours = (F.unix_timestamp(moment) - F.unix_timestamp("_newest")) / 3600.0
        status = (F.when(hours.isNull() | (hours > error_hours), "error")
                  .when(hours > warn_hours, "warn").otherwise("pass"))
        return newest.select(
            F.lit(name).alias("table_name"),
            F.date_format("_newest", "yyyy-MM-dd HH:mm:ss").alias("newest"),
            hours.cast("double").alias("age_hours"), status.alias("status"))

    return _union([one(n, df, c) for n, (df, c) in tables.items()])


def primary_keys_covered() -> list[str]:
    """Models whose declared key lacks either check; empty when all is well."""
    wrong = []
    for spec in MODELS.values():
        keys = {c for c in spec.columns if c.endswith("_key")} | set(spec.unique)
        wrong += [f"{spec.name}.{c}" for c in sorted(keys)
                  if c not in spec.unique or c not in spec.not_null]
    return wrong


def undocumented_columns(layer: str = "marts") -> list[str]:
    """Columns of a layer that have no description."""
    return [f"{spec.name}.{c}" for spec in MODELS.values() if spec.layer == layer
            for c in spec.columns if not spec.docs().get(c)]


def kpi_invariants(donors: DataFrame, payments: DataFrame, deciles: DataFrame,
                   caseload: DataFrame) -> DataFrame:
    """Violations of what must hold for any input, one row per property.

    ``donors``, ``payments`` and ``caseload`` are marts, ``deciles`` the
    vulnerability KPI (at most ten rows).
    """
    identity = F.abs(
        F.col("utilization_pct")
        - F.col("total_disbursed") / F.nullif("total_committed", F.lit(0)) * 100) > 0.001
    utilisation = donors.agg(F.count_if(identity).alias("violations"))

    def outside(c: str) -> Column:
        return (F.col(c) < 0) | (F.col(c) > 1)
    rates = payments.agg(F.count_if(
        outside("success_rate") | outside("rolling_3m_avg_success_rate")).alias("violations"))

    previous = F.lag("max_vulnerability_score").over(Window.orderBy("decile"))
    tiles = deciles.select("decile", (previous > F.col("min_vulnerability_score")).alias("_bad"))
    decile = tiles.agg(F.count_if(
        F.col("_bad") | (F.col("decile") < 1) | (F.col("decile") > 10)).alias("violations"))

    # Inside a month every running total grows by the row's own cases; between
    # months the last total plus the row's cases must not exceed the next total.
    in_month = Window.partitionBy("incident_type", "incident_month").orderBy(
        F.col("risk_level").asc_nulls_last(), F.col("host_district").asc_nulls_last())
    step = caseload.select("incident_type", "incident_month", "cumulative_cases", (
        F.lag("cumulative_cases").over(in_month) > F.col("cumulative_cases")).alias("_bad"))
    months = step.groupBy("incident_type", "incident_month").agg(
        F.min("cumulative_cases").alias("_low"), F.max("cumulative_cases").alias("_high"),
        F.count_if("_bad").alias("_inside"))
    by_month = Window.partitionBy("incident_type").orderBy(
        F.col("incident_month").asc_nulls_last())
    jumps = months.select("_inside", (F.lag("_high").over(by_month) > F.col("_low"))
                          .cast("int").alias("_jump"))
    cumulative = jumps.agg(
        (F.coalesce(F.sum("_inside"), F.lit(0)) + F.coalesce(F.sum("_jump"), F.lit(0)))
        .alias("violations"))

    parts = {"utilisation_identity": utilisation, "rates_in_unit_range": rates,
             "deciles_ordered": decile, "cumulative_monotone": cumulative}
    return _union([df.select(F.lit(n).alias("property"), F.col("violations").cast("bigint"))
                   for n, df in parts.items()])
