"""Shared fixtures: one local session, a fresh lake per test."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from medallion.session import get_spark  # noqa: E402
from medallion.sources.lake import Lake  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", "local[8]", spark__sql__shuffle__partitions=4,
                        spark__ui__enabled="false", spark__driver__memory="4g",
                        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def inputs(spark):
    from workload.queries import Inputs
    return Inputs(spark, SF)
