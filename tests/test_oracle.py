"""Every registered query against its SQL in DuckDB, exact values."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_compare import difference, duck
from workload import queries as library

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
# their column headers are the months and categories found at this size
WIDE = {k for k in QUERIES if k.endswith("_wide")}


@pytest.fixture(scope="module")
def engines():
    return {sf: duck(f"/root/testdata/{sf}") for sf in ("sf0.001", "sf0.01")}


def test_every_query_of_the_library_has_an_oracle():
    """Queries that SQL cannot express are tested with their operators."""
    assert set(ORACLE) <= set(QUERIES)
    assert set(library.queries()) <= set(ORACLE)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, engines, key):
    sf = "sf0.01" if key in WIDE else "sf0.001"
    df = QUERIES[key](spark, f"/root/testdata/{sf}")
    assert difference(df, engines[sf], ORACLE[key]) is None


def test_flagship_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["district", "program", "reporting_month"]
