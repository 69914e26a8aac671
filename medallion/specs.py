"""Declarations: the nine sources and the models with their columns and checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceSpec:
    """One input file: where it is, how it is encoded, what it holds."""

    name: str
    file: str
    format: str
    key: str
    schema: T.StructType
    freshness_column: str


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
          "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType()}


def _schema(columns: str) -> T.StructType:
    """``"a string, b int"`` as a schema; unlike DDL parsing this needs no session."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])


# File names, formats and raw column lists of the nine datasets.
# Dates inside ndjson are epoch milliseconds; Avro files hold strings only.
SOURCES: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        SourceSpec(
            "beneficiaries", "beneficiaries.csv.gz", "csv.gz", "beneficiary_id",
            _schema("beneficiary_id string, cnic string, name string, gender string, age int, "
                    "phone string, district string, tehsil string, union_council string, "
                    "program string, registration_date string, poverty_score double, "
                    "family_size int, is_disabled string, is_eligible string, "
                    "bank_account string, last_payment_date string"),
            "registration_date"),
        SourceSpec(
            "payments", "payments.parquet", "parquet", "payment_id",
            _schema("payment_id string, beneficiary_id string, amount long, payment_date date, "
                    "payment_mode string, payment_status string, bank_code string, "
                    "transaction_ref string, disbursement_center string"),
            "payment_date"),
        SourceSpec(
            "surveys", "surveys.json", "json", "survey_id",
            _schema("survey_id string, beneficiary_id string, survey_date long, program string, "
                    "metric_type string, metric_value long, field_worker string, "
                    "district string, data_quality_score double, is_verified boolean"),
            "survey_date"),
        SourceSpec(
            "inventory", "inventory.avro", "avro", "item_id",
            _schema("item_id string, item_name string, item_type string, quantity string, "
                    "unit string, warehouse string, last_updated string, "
                    "reorder_level string, program string, supplier string"),
            "last_updated"),
        SourceSpec(
            "complaints", "complaints.csv.gz", "csv.gz", "complaint_id",
            _schema("complaint_id string, cnic string, complaint_date string, category string, "
                    "description string, status string, resolution_date string, "
                    "assigned_to string, district string"),
            "complaint_date"),
        SourceSpec(
            "donor_reports", "donor_reports.parquet", "parquet", "report_id",
            _schema("report_id string, donor string, program string, district string, "
                    "amount_committed double, amount_disbursed double, "
                    "disbursement_date date, currency string, project_code string, "
                    "reporting_period string"),
            "disbursement_date"),
        SourceSpec(
            "afghan_refugees", "afghan_refugees.json", "json", "refugee_id",
            _schema("refugee_id string, unhcr_case_number string, name string, gender string, "
                    "age long, province_of_origin string, arrival_wave string, "
                    "documentation_type string, camp_settlement string, host_district string, "
                    "family_size long, vulnerability_score double, "
                    "is_unaccompanied_minor boolean, has_disability boolean, "
                    "enrolled_in_program string, registration_date long, "
                    "last_verification long, return_intention string"),
            "registration_date"),
        SourceSpec(
            "refugee_assistance", "refugee_assistance.avro", "avro", "assistance_id",
            _schema("assistance_id string, refugee_id string, program string, modality string, "
                    "amount_usd string, amount_pkr string, delivery_date string, "
                    "delivery_point string, status string, implementing_org string, "
                    "host_district string"),
            "delivery_date"),
        SourceSpec(
            "refugee_protection", "refugee_protection.csv.gz", "csv.gz", "case_id",
            _schema("case_id string, refugee_id string, incident_type string, "
                    "incident_date string, reported_to string, case_status string, "
                    "risk_level string, host_district string, case_worker string, "
                    "follow_up_date string"),
            "incident_date"),
    )
}


@dataclass(frozen=True)
class ModelSpec:
    """A model's contract: grain, documented columns and declared checks."""

    name: str
    layer: str
    grain: tuple[str, ...]
    columns: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def docs(self) -> dict[str, str]:
        return {c: COLUMN_DOCS[c] for c in self.columns if c in COLUMN_DOCS}


def _w(text: str) -> tuple[str, ...]:
    return tuple(text.split())


# Columns, grain and checks of the eighteen models.
MODELS: dict[str, ModelSpec] = {
    m.name: m
    for m in (
        ModelSpec(
            "stg_beneficiaries", "staging", ("beneficiary_key",),
            _w("beneficiary_key cnic name gender phone district tehsil union_council program "
               "bank_account age family_size registration_date last_payment_date "
               "poverty_score is_eligible is_disabled"),
            _w("beneficiary_key"), _w("beneficiary_key"), {"gender": ("Female", "Male")}),
        ModelSpec(
            "stg_payments", "staging", ("payment_id",),
            _w("payment_id beneficiary_id payment_mode payment_status bank_code "
               "transaction_ref disbursement_center amount payment_date"),
            _w("payment_id beneficiary_id"), _w("payment_id"),
            {"payment_status": ("Success", "Failed", "Pending")}),
        ModelSpec(
            "stg_surveys", "staging", ("survey_id",),
            _w("survey_id beneficiary_id metric_name surveyor district program survey_date "
               "metric_value"),
            _w("survey_id beneficiary_id"), _w("survey_id")),
        ModelSpec(
            "stg_inventory", "staging", ("item_id",),
            _w("item_id item_name item_type unit warehouse program supplier quantity "
               "reorder_level last_updated"),
            _w("item_id"), _w("item_id")),
        ModelSpec(
            "stg_complaints", "staging", ("complaint_id",),
            _w("complaint_id cnic category description status assigned_to district "
               "complaint_date resolution_date"),
            _w("complaint_id"), _w("complaint_id"),
            {"status": ("Open", "In Progress", "Resolved", "Rejected")}),
        ModelSpec(
            "stg_donor_reports", "staging", ("report_id",),
            _w("report_id donor program reporting_period currency amount_committed "
               "amount_disbursed disbursement_date"),
            _w("report_id"), _w("report_id")),
        ModelSpec(
            "stg_afghan_refugees", "staging", ("refugee_id",),
            _w("refugee_id unhcr_case_number name gender age province_of_origin arrival_wave "
               "documentation_type camp_settlement host_district family_size "
               "is_unaccompanied_minor has_disability enrolled_in_program return_intention "
               "registration_date last_verification vulnerability_score"),
            _w("refugee_id"), _w("refugee_id"),
            {"gender": ("Female", "Male"), "return_intention": ("Yes", "No", "Undecided")}),
        ModelSpec(
            "stg_refugee_assistance", "staging", ("assistance_id",),
            _w("assistance_id refugee_id program modality delivery_point status "
               "implementing_org host_district amount_usd amount_pkr delivery_date"),
            _w("assistance_id refugee_id"), _w("assistance_id")),
        ModelSpec(
            "stg_refugee_protection", "staging", ("case_id",),
            _w("case_id refugee_id incident_type risk_level case_status reported_to "
               "assigned_officer host_district incident_date follow_up_date"),
            _w("case_id refugee_id"), _w("case_id"),
            {"risk_level": ("Critical", "High", "Medium", "Low")}),
        ModelSpec(
            "int_beneficiaries_payments", "intermediate", ("beneficiary_key",),
            _w("beneficiary_key cnic name gender age district tehsil union_council program "
               "registration_date poverty_score family_size is_disabled is_eligible "
               "bank_account total_payments total_amount last_payment_date"),
            _w("beneficiary_key total_payments total_amount"), _w("beneficiary_key")),
        ModelSpec(
            "int_refugees_assistance", "intermediate", ("refugee_id",),
            _w("refugee_id unhcr_case_number name gender age province_of_origin arrival_wave "
               "documentation_type camp_settlement host_district family_size "
               "vulnerability_score is_unaccompanied_minor has_disability "
               "enrolled_in_program return_intention registration_date last_verification "
               "total_assistance_usd delivery_count last_delivery_date"),
            _w("refugee_id total_assistance_usd delivery_count"), _w("refugee_id")),
        ModelSpec(
            "int_donor_program_aggregates", "intermediate", ("donor", "program"),
            _w("donor program total_committed total_disbursed utilization_pct report_count "
               "first_disbursement_date last_disbursement_date"),
            _w("donor program total_committed total_disbursed")),
        ModelSpec(
            "mart_payment_kpis", "marts", ("district", "program", "reporting_month"),
            _w("district program reporting_month total_payments successful_payments "
               "success_rate rolling_3m_avg_success_rate"),
            _w("district program reporting_month total_payments successful_payments "
               "success_rate rolling_3m_avg_success_rate")),
        ModelSpec(
            "mart_donor_budget_vs_actual", "marts", ("donor", "program"),
            _w("donor program total_committed total_disbursed variance utilization_pct "
               "utilization_rank"),
            _w("donor program total_committed total_disbursed variance utilization_rank")),
        ModelSpec(
            "mart_refugee_assistance_summary", "marts",
            ("program", "modality", "host_district"),
            _w("program modality host_district total_beneficiaries total_amount_usd "
               "avg_amount_usd delivery_count avg_vulnerability_score"),
            _w("program modality host_district total_beneficiaries total_amount_usd "
               "avg_amount_usd delivery_count")),
        ModelSpec(
            "mart_protection_caseload", "marts",
            ("incident_type", "risk_level", "host_district", "incident_month"),
            _w("incident_type risk_level host_district incident_month open_cases total_cases "
               "cumulative_cases"),
            _w("incident_type risk_level host_district incident_month open_cases total_cases "
               "cumulative_cases")),
        ModelSpec(
            "int_survey_trends", "intermediate", ("survey_id",),
            _w("survey_id metric_name metric_value survey_date district program")),
        ModelSpec(
            "mart_survey_metric_trends", "marts",
            ("metric_name", "district", "program", "survey_month"),
            _w("metric_name district program survey_month avg_metric_value response_count")),
    )
}

COLUMN_DOCS: dict[str, str] = {
    "district": "District the row is attributed to; NULL when the lookup found none.",
    "host_district": "District hosting the refugee or the delivery.",
    "program": "Programme the row belongs to.",
    "reporting_month": "First day of the month the payments fall in.",
    "total_payments": "Number of payments, whatever their status.",
    "successful_payments": "Number of payments with status Success.",
    "success_rate": "Successful payments over all payments, 0 to 1.",
    "rolling_3m_avg_success_rate":
        "Mean success rate of this month's row and the two rows before it.",
    "donor": "Funding organisation.",
    "total_committed": "Sum of committed amounts.",
    "total_disbursed": "Sum of disbursed amounts, each capped at its commitment.",
    "variance": "Committed minus disbursed.",
    "utilization_pct": "Disbursed as a percentage of committed; NULL without commitment.",
    "utilization_rank": "Rank inside the programme, 1 = highest utilisation.",
    "modality": "How assistance was delivered.",
    "total_beneficiaries": "Distinct refugees reached.",
    "total_amount_usd": "Sum of delivered USD.",
    "avg_amount_usd": "Delivered USD per delivery; missing amounts count as zero.",
    "delivery_count": "Number of deliveries.",
    "avg_vulnerability_score": "Mean vulnerability score over deliveries with a score.",
    "incident_type": "Kind of protection incident.",
    "risk_level": "Assessed risk of the incident.",
    "incident_month": "First day of the month of the incident.",
    "open_cases": "Cases not closed.",
    "total_cases": "All cases.",
    "cumulative_cases": "Running number of cases of the incident type.",
    "metric_name": "Surveyed metric.",
    "survey_month": "First day of the month of the survey.",
    "avg_metric_value": "Mean of the surveyed value.",
    "response_count": "Number of survey answers.",
}
