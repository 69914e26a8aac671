"""Staging -> intermediate: facts aggregated to the dimension's key, then joined.

Each fact is reduced to one row per key before the join, so the join never sees
a hot key, and both sides of it are hash-partitioned on that key only once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions import PARTS, exact_parts, exact_sum, exact_total, safe_ratio
from medallion.specs import MODELS


def int_beneficiaries_payments(beneficiaries: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per beneficiary with payment count, amount and last payment."""
    paid = payments.groupBy(F.col("beneficiary_id").alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("amount").alias("_amount"),
        F.max("payment_date").alias("_last"))
    out = MODELS["int_beneficiaries_payments"].columns
    computed = {
        "total_payments": F.coalesce("_n", F.lit(0)).cast("bigint"),
        "total_amount": F.coalesce("_amount", F.lit(0)).cast("bigint"),
        "last_payment_date": F.col("_last"),
    }
    people = beneficiaries.drop("last_payment_date")
    return people.join(paid, F.col("beneficiary_key") == F.col("_key"), "left").select(
        *(computed.get(c, F.col(c)).alias(c) for c in out))


def int_refugees_assistance(refugees: DataFrame, assistance: DataFrame) -> DataFrame:
    """One row per refugee with delivered USD, number of deliveries and the last one."""
    helped = assistance.groupBy(F.col("refugee_id").alias("_key")).agg(
        exact_sum("amount_usd").alias("_usd"),
        F.count(F.lit(1)).alias("_n"),
        F.max("delivery_date").alias("_last"))
    out = MODELS["int_refugees_assistance"].columns
    computed = {
        "total_assistance_usd": F.coalesce("_usd", F.lit(0.0)),
        "delivery_count": F.coalesce("_n", F.lit(0)).cast("bigint"),
        "last_delivery_date": F.col("_last"),
    }
    return refugees.join(helped, F.col("refugee_id") == F.col("_key"), "left").select(
        *(computed.get(c, F.col(c)).alias(c) for c in out))


def donor_parts(donor_reports: DataFrame) -> DataFrame:
    """Sums per donor and programme in exact parts; parts of separate sets of reports add up."""
    return donor_reports.groupBy("donor", "program").agg(
        *exact_parts("amount_committed", "committed"),
        *exact_parts("amount_disbursed", "disbursed"),
        F.count("report_id").alias("report_count"),
        F.min("disbursement_date").alias("first_disbursement_date"),
        F.max("disbursement_date").alias("last_disbursement_date"))


def donor_totals(parts: DataFrame) -> DataFrame:
    """Committed and disbursed totals from their parts."""
    totals = parts.withColumns({
        f"total_{m}": exact_total(*(F.col(f"{m}_{p}") for p in PARTS))
        for m in ("committed", "disbursed")})
    return totals.withColumn(
        "utilization_pct", safe_ratio("total_disbursed", "total_committed", 100)
    ).select(*MODELS["int_donor_program_aggregates"].columns)


def int_donor_program_aggregates(donor_reports: DataFrame) -> DataFrame:
    """Committed and disbursed totals per donor and programme."""
    return donor_totals(donor_parts(donor_reports))


def int_survey_trends(surveys: DataFrame, beneficiaries: DataFrame) -> DataFrame:
    """Survey answers with the beneficiary's district and programme.

    Answers without a beneficiary match nobody; they stay out of the join, where they
    would all have one key.  A beneficiary with very many answers is split by adaptive
    execution, which may split the answers' side of a left join.
    """
    people = beneficiaries.select("beneficiary_key", "district", "program")
    answers = surveys.drop("district", "program")
    out = MODELS["int_survey_trends"].columns
    named = answers.where(F.col("beneficiary_id").isNotNull())
    joined = named.join(
        people, named["beneficiary_id"] == people["beneficiary_key"], "left").select(*out)
    nobody = answers.where(F.col("beneficiary_id").isNull()).select(*(
        F.lit(None).cast(people.schema[c].dataType).alias(c)
        if c in people.columns and c not in answers.columns else F.col(c) for c in out))
    return joined.unionByName(nobody)
