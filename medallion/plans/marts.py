"""Intermediate -> marts: the tables reports read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions import PARTS, exact_parts, exact_total, month_of, safe_ratio
from medallion.operators import enrich_then_total, rank_rows, running_total
from medallion.specs import MODELS



def payment_counts(payments: DataFrame, beneficiaries: DataFrame, month: str) -> DataFrame:
    """Payments and successes per district, programme and month; counts of separate sets of
    payments add up."""
    return enrich_then_total(
        payments, beneficiaries, "beneficiary_id", "beneficiary_key",
        [month_of("payment_date").alias(month)], ["district", "program"],
        {"total_payments": F.count(F.lit(1)),
         "successful_payments": F.count_if(F.col("payment_status") == "Success")})


def payment_rates(counts: DataFrame, month: str) -> DataFrame:
    """Counts with the rate and its mean over this row and the two before (rows, not
    calendar months)."""
    rated = counts.withColumn(
        "success_rate", safe_ratio("successful_payments", "total_payments"))
    last_three = (Window.partitionBy("district", "program")
                  .orderBy(F.col(month).asc_nulls_last()).rowsBetween(-2, 0))
    return rated.withColumn("rolling", F.avg("success_rate").over(last_three))


def monthly_payments(payments: DataFrame, beneficiaries: DataFrame, month: str) -> DataFrame:
    return payment_rates(payment_counts(payments, beneficiaries, month), month)


def payment_kpis(counts: DataFrame) -> DataFrame:
    """The mart from its counts."""
    kpis = payment_rates(counts, "reporting_month")
    return kpis.withColumnRenamed("rolling", "rolling_3m_avg_success_rate").select(
        *MODELS["mart_payment_kpis"].columns)


def mart_payment_kpis(payments: DataFrame, beneficiaries: DataFrame) -> DataFrame:
    return payment_kpis(payment_counts(payments, beneficiaries, "reporting_month"))


def mart_donor_budget_vs_actual(donor_totals: DataFrame) -> DataFrame:
    """Variance, and rank by utilisation inside each programme."""
    by_use = Window.partitionBy("program").orderBy(F.col("utilization_pct").desc_nulls_last())
    return donor_totals.select(
        "donor", "program", "total_committed", "total_disbursed",
        (F.col("total_committed") - F.col("total_disbursed")).alias("variance"),
        "utilization_pct",
        F.rank().over(by_use).cast("bigint").alias("utilization_rank"))


def mart_donor_budget_many_donors(donor_totals: DataFrame) -> DataFrame:
    """The same mart where a programme has more donors than a task should sort."""
    ranked = rank_rows(donor_totals, ["program"], "utilization_pct", "utilization_rank")
    return ranked.withColumn(
        "variance", F.col("total_committed") - F.col("total_disbursed")
    ).select(*MODELS["mart_donor_budget_vs_actual"].columns)


def mart_refugee_assistance_summary(refugees: DataFrame, assistance: DataFrame) -> DataFrame:
    """Reach, spend and mean vulnerability per programme, modality and district.

    Deliveries are totalled per refugee first.  That makes the distinct count a
    plain count, and a refugee with very many deliveries meets the score lookup
    as a handful of rows.  Several rows for one refugee id in ``refugees``
    weigh the deliveries just as a row-level join would.
    """
    segment = ["program", "modality", "host_district"]
    per_refugee = assistance.groupBy("refugee_id", *segment).agg(
        *exact_parts("amount_usd", "usd"), F.count(F.lit(1)).alias("n"))
    scores = refugees.groupBy(F.col("refugee_id").alias("_id")).agg(
        F.count(F.lit(1)).alias("copies"),
        *exact_parts("vulnerability_score", "score"),
        F.count("vulnerability_score").alias("scored"))
    copies = F.coalesce("copies", F.lit(1))
    joined = per_refugee.join(scores, F.col("refugee_id") == F.col("_id"), "left")
    totals = joined.groupBy(*segment).agg(
        F.count("refugee_id").alias("total_beneficiaries"),
        exact_total(*(F.sum(F.col(f"usd_{p}") * copies) for p in PARTS))
        .alias("total_amount_usd"),
        F.sum(F.col("n") * copies).alias("delivery_count"),
        exact_total(*(F.sum(F.col(f"score_{p}") * F.col("n"))
                      for p in PARTS)).alias("_score"),
        F.sum(F.col("n") * F.col("scored")).alias("_scored"))
    return totals.select(
        *segment, "total_beneficiaries", "total_amount_usd",
        safe_ratio("total_amount_usd", "delivery_count").alias("avg_amount_usd"),
        "delivery_count",
        safe_ratio("_score", "_scored").alias("avg_vulnerability_score"))


def monthly_cases(protection: DataFrame) -> DataFrame:
    """Open and total cases per type, risk, district and month; separate sets add up."""
    return protection.groupBy(
        "incident_type", "risk_level", "host_district",
        month_of("incident_date").alias("incident_month"),
    ).agg(
        F.count_if(F.col("case_status") != "Closed").alias("open_cases"),
        F.count(F.lit(1)).alias("total_cases"))


def caseload(monthly: DataFrame) -> DataFrame:
    """Monthly cases with the running total per incident type.

    Months tie between risk levels and districts, so the running total goes by
    month, then risk level, then district.
    """
    return running_total(
        monthly, ["incident_type"], ["incident_month", "risk_level", "host_district"],
        "total_cases", "cumulative_cases",
    ).select(*MODELS["mart_protection_caseload"].columns)


def mart_protection_caseload(protection: DataFrame) -> DataFrame:
    return caseload(monthly_cases(protection))


def mart_survey_metric_trends(surveys: DataFrame, beneficiaries: DataFrame) -> DataFrame:
    """Mean surveyed value and number of answers per metric, place and month."""
    answers = surveys.drop("district", "program")
    totals = enrich_then_total(
        answers, beneficiaries, "beneficiary_id", "beneficiary_key",
        [F.col("metric_name"), month_of("survey_date").alias("survey_month")],
        ["district", "program"],
        {"_sum": F.sum(F.col("metric_value").cast("bigint")),
         "_n": F.count("metric_value"),
         "response_count": F.count(F.lit(1))})
    return totals.withColumn("avg_metric_value", safe_ratio("_sum", "_n")).select(
        *MODELS["mart_survey_metric_trends"].columns)
