from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_tables import ODD_ROWS, SF, documents  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, ODD_ROWS)


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, None, None), (None, 1, 1), (3, 0, 1), (9, 0, 1), (9, 0, 1), (12, 1, 0)],
        "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
