"""Silver entities -> staging views: pick, rename and type columns.  No joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions import blank_to_null
from medallion.specs import MODELS

# staging name -> source name, where they differ
RENAMED = {
    "stg_beneficiaries": {"beneficiary_key": "beneficiary_id"},
    "stg_surveys": {"metric_name": "metric_type", "surveyor": "field_worker"},
    "stg_refugee_protection": {"assigned_officer": "case_worker"},
}

# Columns staged under another type.
TYPED = {
    "date": ("registration_date", "last_payment_date", "payment_date", "survey_date",
             "complaint_date", "resolution_date", "disbursement_date", "last_verification",
             "delivery_date", "incident_date", "follow_up_date"),
    "timestamp": ("last_updated",),
    "boolean": ("is_eligible", "is_disabled"),
    "int": ("metric_value", "quantity", "reorder_level"),
    "bigint": ("amount",),
    "double": ("poverty_score", "vulnerability_score", "amount_committed",
               "amount_disbursed", "amount_usd", "amount_pkr"),
}
_TYPE_OF = {c: t for t, cols in TYPED.items() for c in cols}

# Columns in which an empty text means NULL.
BLANK_IS_NULL = {
    "stg_beneficiaries": ("cnic", "name", "gender", "phone", "district", "tehsil",
                          "union_council", "program", "bank_account"),
}


def _stage(silver: DataFrame, model: str) -> DataFrame:
    renamed = RENAMED.get(model, {})
    blanks = BLANK_IS_NULL.get(model, ())

    def one(column: str) -> Column:
        c = F.col(renamed.get(column, column))
        if column in blanks:
            c = blank_to_null(c)
        if column in _TYPE_OF:
            c = c.cast(_TYPE_OF[column])
        return c.alias(column)

    return silver.select(*(one(c) for c in MODELS[model].columns))


def stg_beneficiaries(silver: DataFrame) -> DataFrame:
    return _stage(silver, "stg_beneficiaries")


def stg_payments(silver: DataFrame) -> DataFrame:
    return _stage(silver, "stg_payments")


def stg_surveys(silver: DataFrame) -> DataFrame:
    return _stage(silver, "stg_surveys")


def stg_inventory(silver: DataFrame) -> DataFrame:
    return _stage(silver, "stg_inventory")


def stg_complaints(silver: DataFrame) -> DataFrame:
    return _stage(silver, "stg_complaints")


def stg_donor_reports(silver: DataFrame) -> DataFrame:
    """Disbursed is capped at committed; a NULL disbursement counts as fully spent."""
    staged = _stage(silver, "stg_donor_reports")
    capped = F.least("amount_disbursed", "amount_committed")
    return staged.withColumn("amount_disbursed", capped)


def stg_afghan_refugees(silver: DataFrame) -> DataFrame:
    return _stage(silver, "stg_afghan_refugees")


def stg_refugee_assistance(silver: DataFrame) -> DataFrame:
    return _stage(silver, "stg_refugee_assistance")


def stg_refugee_protection(silver: DataFrame) -> DataFrame:
    return _stage(silver, "stg_refugee_protection")


# silver table -> its staging view
STAGING = {
    "beneficiaries": stg_beneficiaries,
    "payments": stg_payments,
    "surveys": stg_surveys,
    "inventory": stg_inventory,
    "complaints": stg_complaints,
    "donor_reports": stg_donor_reports,
    "afghan_refugees": stg_afghan_refugees,
    "refugee_assistance": stg_refugee_assistance,
    "refugee_protection": stg_refugee_protection,
}
