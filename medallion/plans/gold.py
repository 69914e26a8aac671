"""All models by name over a set of silver tables, and the gold build."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from medallion.plans import intermediate, marts
from medallion.plans.staging import STAGING
from medallion.sources.ingest import PARALLEL_JOBS
from medallion.sources.lake import Lake
from medallion.specs import MODELS

# model -> its plan and the models it reads
PLANS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "int_beneficiaries_payments":
        (intermediate.int_beneficiaries_payments, ("stg_beneficiaries", "stg_payments")),
    "int_refugees_assistance":
        (intermediate.int_refugees_assistance,
         ("stg_afghan_refugees", "stg_refugee_assistance")),
    "int_donor_program_aggregates":
        (intermediate.int_donor_program_aggregates, ("stg_donor_reports",)),
    "int_survey_trends":
        (intermediate.int_survey_trends, ("stg_surveys", "stg_beneficiaries")),
    "mart_payment_kpis":
        (marts.mart_payment_kpis, ("stg_payments", "stg_beneficiaries")),
    "mart_donor_budget_vs_actual":
        (marts.mart_donor_budget_vs_actual, ("int_donor_program_aggregates",)),
    "mart_refugee_assistance_summary":
        (marts.mart_refugee_assistance_summary,
         ("stg_afghan_refugees", "stg_refugee_assistance")),
    "mart_protection_caseload":
        (marts.mart_protection_caseload, ("stg_refugee_protection",)),
    "mart_survey_metric_trends":
        (marts.mart_survey_metric_trends, ("stg_surveys", "stg_beneficiaries")),
}


class Models:
    """Lazy models: ``models["mart_payment_kpis"]`` is a DataFrame.

    Staging and intermediate models are inlined by Catalyst, which drops the
    columns a mart does not read.  Only the running total of the protection mart
    stores its monthly counts when the model is first asked for.
    """

    def __init__(self, silver: Callable[[str], DataFrame]):
        self._silver = silver
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in PLANS:
                plan, inputs = PLANS[name]
                self._made[name] = plan(*(self[i] for i in inputs))
            else:
                table = name.removeprefix("stg_")
                self._made[name] = STAGING[table](self._silver(table))
        return self._made[name]


# the month that reports choose ranges of: files hold separate months
SORTED_BY = {"mart_payment_kpis": "reporting_month", "mart_protection_caseload": "incident_month",
             "mart_survey_metric_trends": "survey_month"}


def build_gold(lake: Lake) -> dict[str, int]:
    """Write every mart once as a gold table; returns the new version per mart."""
    models = Models(lambda table: lake.read("silver", table))
    wanted = [n for n, spec in MODELS.items() if spec.layer == "marts"]
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        # a mart is asked for by the thread that writes it, so that no mart waits for the
        # stored counts of another
        done = pool.map(lambda n: lake.write(models[n], "gold", n, SORTED_BY.get(n)), wanted)
        return {n: snapshot.version for n, snapshot in zip(wanted, done)}
