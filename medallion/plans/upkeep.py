"""Marts kept up from what was appended, not rebuilt.

A mart here is the finish of a mergeable state: counts, exact partial sums, smallest and
largest dates, bitmaps of distinct values.  The state is a table of its own; beside it stands
which versions of the silver tables it was made from.  When the fact table has only been
appended to since, and nothing else has changed, the new rows alone are reduced to a state and
merged with the stored one.  Otherwise the state is made from the whole tables.  Both give the
same mart, since a state of two sets of rows is the merge of their states.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions import PARTS
from medallion.plans import intermediate, marts
from medallion.plans.gold import SORTED_BY
from medallion.plans.staging import STAGING
from medallion.sources.lake import Lake, Snapshot


@dataclass(frozen=True)
class Kept:
    """How one mart is kept: ``partial(fact, *others)`` gives the state of some facts,
    ``merge`` how each of its columns combines, ``finish`` the mart."""

    fact: str
    others: tuple[str, ...]
    keys: tuple[str, ...]
    partial: Callable[..., DataFrame]
    merge: Mapping[str, Callable[[str], Column]]
    finish: Callable[[DataFrame], DataFrame]


def _sums(*columns: str) -> dict[str, Callable[[str], Column]]:
    return {c: F.sum for c in columns}


KEPT: dict[str, Kept] = {
    "mart_payment_kpis": Kept(
        "payments", ("beneficiaries",), ("district", "program", "reporting_month"),
        lambda payments, people: marts.payment_counts(payments, people, "reporting_month"),
        _sums("total_payments", "successful_payments"), marts.payment_kpis),
    "mart_donor_budget_vs_actual": Kept(
        "donor_reports", (), ("donor", "program"), intermediate.donor_parts,
        {**_sums(*(f"{m}_{p}" for m in ("committed", "disbursed") for p in PARTS), "report_count"),
         "first_disbursement_date": F.min, "last_disbursement_date": F.max},
        lambda state: marts.mart_donor_budget_vs_actual(intermediate.donor_totals(state))),
    "mart_protection_caseload": Kept(
        "refugee_protection", (),
        ("incident_type", "risk_level", "host_district", "incident_month"),
        marts.monthly_cases, _sums("open_cases", "total_cases"), marts.caseload),
}


def _made_from(lake: Lake, kept: Kept) -> dict[str, int]:
    return {t: lake.snapshot("silver", t).version for t in (kept.fact, *kept.others)}


def _staged(lake: Lake, table: str) -> DataFrame:
    return STAGING[table](lake.read("silver", table))


def next_state(lake: Lake, mart: str) -> tuple[DataFrame, dict[str, int]]:
    """The mart's state for the latest silver versions, and these versions; lazy."""
    kept, now = KEPT[mart], _made_from(lake, KEPT[mart])
    others = [_staged(lake, t) for t in kept.others]
    old = lake.snapshot("state", mart) if lake.versions("state", mart) else None
    then = old.made_from if old else {}
    fresh = None
    if then and all(then.get(t) == now[t] for t in kept.others):
        fresh = lake.added("silver", kept.fact, then[kept.fact])
    if fresh is None:
        return kept.partial(_staged(lake, kept.fact), *others), now
    delta = kept.partial(STAGING[kept.fact](fresh), *others)
    both = lake.read("state", mart).unionByName(delta)
    return both.groupBy(*kept.keys).agg(*(f(c).alias(c) for c, f in kept.merge.items())), now


def keep_up(lake: Lake, mart: str) -> Snapshot:
    """Bring the mart's state and its gold table up to the latest silver versions."""
    state, now = next_state(lake, mart)
    lake.write(state, "state", mart, made_from=now)
    return lake.write(KEPT[mart].finish(lake.read("state", mart)), "gold", mart,
                      SORTED_BY.get(mart))
