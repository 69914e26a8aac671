"""What tests look up in physical plans."""

from __future__ import annotations


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
