"""Left-join enrichment that is safe when one join key dominates the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equi-join condition under which NULL keys match each other."""
    cond = F.lit(True)
    for i, k in enumerate(keys):
        eq = left[k].eqNullSafe(right[k])
        cond = eq if i == 0 else cond & eq
    return cond


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; NULL keys match each other.

    The keys are renamed first, so both sides may come from one frame.
    """
    others = [c for c in right.columns if c not in keys]
    renamed = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys), *others)
    cond = F.lit(True)
    for i, k in enumerate(keys):
        eq = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = eq if i == 0 else cond & eq
    return left.join(renamed, cond, how).drop(*(f"_r_{k}" for k in keys))


def enrich_then_total(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_groups: Sequence[Column],
    dim_groups: Sequence[str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """``fact LEFT JOIN dim GROUP BY dim_groups, fact_groups`` with additive totals.

    The fact table is first totalled per join key and fact group.  A key that
    holds a third of all rows is then reduced to one row per fact group on the
    map side, before anything is shuffled, and only those totals meet the
    dimension.  ``totals`` must be additive (counts and sums); duplicate
    dimension keys multiply them exactly as joining the rows would.
    """
    per_key = fact.groupBy(fact_key, *fact_groups).agg(
        *(expr.alias(name) for name, expr in totals.items())
    )
    group_names = [c for c in per_key.columns if c != fact_key and c not in totals]
    lookup = dim.select(F.col(dim_key).alias("_dim_key"), *dim_groups)
    joined = per_key.join(lookup, per_key[fact_key] == lookup["_dim_key"], "left")
    return joined.groupBy(*dim_groups, *group_names).agg(
        *(F.sum(name).alias(name) for name in totals)
    )
