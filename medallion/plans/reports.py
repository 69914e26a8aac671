"""The data behind each dashboard chart, from the marts.

Every function takes a mart and the viewer's choices and returns the rows to
draw.  Choices left out fall back to what the data offers: the first category in
sort order, the full month range, the first six districts, all risk levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions import exact_sum, percent_text, safe_ratio
from medallion.operators import (
    between_inclusive,
    exact_quantiles,
    first_values,
    grid_long,
    histogram,
    latest_rows,
    pick_value,
    pivot_grid,
    to_long,
)
from medallion.sources.lake import Lake
from medallion.specs import MODELS


def _ordered(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in columns))


# --- whole marts, as the tabs load them ---------------------------------------

EXTRACT_ORDER = {
    "mart_payment_kpis": ("reporting_month", "district", "program"),
    "mart_donor_budget_vs_actual": ("program", "utilization_rank", "donor"),
    "mart_protection_caseload":
        ("incident_month", "incident_type", "risk_level", "host_district"),
    "mart_refugee_assistance_summary": ("host_district", "program", "modality"),
}


def extract(mart: DataFrame, name: str) -> DataFrame:
    """The mart's documented columns in display order."""
    return _ordered(mart.select(*MODELS[name].columns), *EXTRACT_ORDER[name])


# --- payments -------------------------------------------------------------------

def payments_in_scope(mart: DataFrame, program: str | None = None,
                      start: object | None = None, end: object | None = None) -> DataFrame:
    return between_inclusive(pick_value(mart, "program", program),
                             "reporting_month", start, end)


def payments_from(lake: Lake, program: str | None = None, start: object | None = None,
                  end: object | None = None) -> DataFrame:
    """``payments_in_scope`` of the stored mart; only files with months in range are opened.

    The default programme is the first one of the whole mart.
    """
    name = "mart_payment_kpis"
    chosen = F.lit(program) if program is not None else lake.read("gold", name).select(
        F.min("program")).scalar()
    return lake.read_range("gold", name, start, end).where(F.col("program") == chosen)


def latest_cases(lake: Lake, incident_type: str) -> DataFrame:
    """Cases of the newest month of the stored mart, which its zones tell."""
    name = "mart_protection_caseload"
    newest = lake.bounds("gold", name).first()["high"]
    return lake.read_range("gold", name, newest, newest).where(
        F.col("incident_type") == incident_type)


def success_grid(scope: DataFrame) -> DataFrame:
    """District x month, mean success rate."""
    return _ordered(grid_long(scope, "district", "reporting_month", "success_rate",
                              F.avg("success_rate")), "district", "reporting_month")


def success_grid_wide(scope: DataFrame, months: Sequence[object] | None = None) -> DataFrame:
    return pivot_grid(scope, "district", "reporting_month", F.avg("success_rate"), months)


def latest_month(scope: DataFrame) -> DataFrame:
    """Districts of the most recent month, worst success rate first."""
    return _ordered(
        latest_rows(scope, "reporting_month").select(
            "reporting_month", "district", "success_rate",
            percent_text("success_rate").alias("label")),
        "success_rate", "district")


def payment_series(scope: DataFrame, districts: Sequence[str] | None = None,
                   default_districts: int = 6) -> DataFrame:
    """Spot rate, rolling rate and volume per month for a set of districts."""
    if districts is not None:
        chosen = scope.where(F.col("district").isin(list(districts)))
    else:
        first = first_values(scope, "district", default_districts)
        chosen = scope.join(F.broadcast(first), "district", "left_semi")
    return _ordered(
        chosen.select("district", "reporting_month", "success_rate",
                      "rolling_3m_avg_success_rate", "total_payments"),
        "district", "reporting_month")


# --- donors -----------------------------------------------------------------------

def budget_long(mart: DataFrame, program: str | None = None) -> DataFrame:
    """Committed and disbursed as two rows per donor."""
    return to_long(
        pick_value(mart, "program", program), ["donor", "program"],
        {"total_committed": "Committed", "total_disbursed": "Disbursed"}, "metric", "amount")


def utilization_ranked(mart: DataFrame, program: str | None = None) -> DataFrame:
    """Donors of a programme by rank; the label reads the value as a fraction."""
    return _ordered(
        pick_value(mart, "program", program).select(
            "donor", "program", "utilization_pct", "utilization_rank",
            percent_text("utilization_pct").alias("label")),
        "utilization_rank", "donor")


def scatter(mart: DataFrame, program: str | None = None,
            whole_table: bool = False) -> DataFrame:
    """Committed against disbursed, with the end of the diagonal as ``axis_max``."""
    points = mart if whole_table else pick_value(mart, "program", program)
    top = points.agg(F.greatest(F.max("total_committed"), F.max("total_disbursed"))).scalar()
    axis = F.coalesce(F.nullif(top, F.lit(0.0)), F.lit(1.0))
    return points.select("donor", "program", "total_committed", "total_disbursed",
                         "utilization_pct", "variance", "utilization_rank",
                         axis.alias("axis_max"))


def utilization_grid(mart: DataFrame) -> DataFrame:
    """Donor x programme, mean utilisation."""
    return _ordered(grid_long(mart, "donor", "program", "utilization_pct",
                              F.avg("utilization_pct")), "donor", "program")


def utilization_grid_wide(mart: DataFrame, programs: Sequence[str] | None = None) -> DataFrame:
    return pivot_grid(mart, "donor", "program", F.avg("utilization_pct"), programs)


# --- protection -------------------------------------------------------------------

def cases_in_scope(mart: DataFrame, incident_type: str | None = None,
                   start: object | None = None, end: object | None = None,
                   risks: Sequence[str] | None = None) -> DataFrame:
    scope = between_inclusive(pick_value(mart, "incident_type", incident_type),
                              "incident_month", start, end)
    keep = F.col("risk_level").isNotNull() if risks is None else (
        F.col("risk_level").isin(list(risks)))
    return scope.where(keep)


def cases_by_risk(scope: DataFrame) -> DataFrame:
    """Monthly open and total cases per risk level, summed over districts."""
    return _ordered(
        scope.groupBy("incident_month", "risk_level").agg(
            F.sum("open_cases").alias("open_cases"),
            F.sum("total_cases").alias("total_cases")),
        "incident_month", "risk_level")


def cases_grid(scope: DataFrame) -> DataFrame:
    """District x month, total cases."""
    return _ordered(grid_long(scope, "host_district", "incident_month", "total_cases",
                              F.sum("total_cases")), "host_district", "incident_month")


def cases_grid_wide(scope: DataFrame, months: Sequence[object] | None = None) -> DataFrame:
    return pivot_grid(scope, "host_district", "incident_month", F.sum("total_cases"), months)


def open_vs_total(scope: DataFrame) -> DataFrame:
    return _ordered(
        scope.groupBy("incident_month").agg(
            F.sum("open_cases").alias("open_cases"),
            F.sum("total_cases").alias("total_cases")),
        "incident_month")


def case_hierarchy(scope: DataFrame) -> DataFrame:
    """Latest month: cases per risk level and per district inside it, with shares.

    No rows when the month holds no cases at all.
    """
    latest = latest_rows(scope, "incident_month")
    total = latest.agg(F.sum("total_cases")).scalar()
    levels = latest.rollup("risk_level", "host_district").agg(
        F.grouping_id().alias("_level"), F.sum("total_cases").alias("total_cases"))
    return levels.where((F.col("_level") < 3) & (total > 0)).select(
        F.when(F.col("_level") == 0, "district").otherwise("risk").alias("level"),
        "risk_level", "host_district", "total_cases",
        safe_ratio("total_cases", total).alias("share"))


# --- assistance -------------------------------------------------------------------

def reach_and_spend(mart: DataFrame, program: str | None = None) -> DataFrame:
    return pick_value(mart, "program", program).select(
        "modality", "host_district", "total_beneficiaries", "total_amount_usd",
        "delivery_count", "avg_amount_usd", "avg_vulnerability_score")


def marginals(mart: DataFrame, program: str | None = None, bins: int = 20) -> DataFrame:
    """Histograms of reach and spend along the two axes of the scatter."""
    scope = pick_value(mart, "program", program)
    frames = [histogram(scope, c, bins).withColumn("axis", F.lit(c))
              for c in ("total_beneficiaries", "total_amount_usd")]
    return frames[0].unionByName(frames[1]).select(
        "axis", "bin", "bin_start", "bin_end", "frequency")


def top_districts(mart: DataFrame, program: str | None = None, n: int = 12) -> DataFrame:
    """The ``n`` districts with the highest spend, smallest of them first."""
    spend = pick_value(mart, "program", program).groupBy("host_district").agg(
        exact_sum("total_amount_usd").alias("total_amount_usd"))
    best = spend.orderBy(F.col("total_amount_usd").desc_nulls_last(),
                         F.col("host_district").asc_nulls_last()).limit(n)
    return best.orderBy("total_amount_usd", "host_district")


def box_by_modality(mart: DataFrame, program: str | None = None) -> DataFrame:
    """Five-number summary of the mean USD per delivery."""
    return box(pick_value(mart, "program", program), ["modality"], "avg_amount_usd")


def box(df: DataFrame, groups: Sequence[str], value: str,
        piece_rows: int = 1_000_000) -> DataFrame:
    """Points and five-number summary of a value per group, of any number of rows."""
    fifths = exact_quantiles(df, groups, value, (0.0, 0.25, 0.5, 0.75, 1.0), "_q", piece_rows)
    return fifths.select(*groups, F.col("n").alias("points"), *(
        F.col("_q")[i].alias(n) for i, n in
        enumerate(("minimum", "lower_quartile", "median", "upper_quartile", "maximum"))))


def spend_grid(mart: DataFrame, program: str | None = None) -> DataFrame:
    """District x modality, total USD."""
    return _ordered(grid_long(pick_value(mart, "program", program), "host_district",
                              "modality", "total_amount_usd", exact_sum("total_amount_usd")),
                    "host_district", "modality")


def spend_grid_wide(mart: DataFrame, program: str | None = None,
                    modalities: Sequence[str] | None = None) -> DataFrame:
    return pivot_grid(pick_value(mart, "program", program), "host_district", "modality",
                      F.sum("total_amount_usd"), modalities)
