"""How much disk file and table round trips take besides their input."""

from __future__ import annotations

import glob
import os
import tempfile
import time
import uuid

import pytest
from plans import plan_of

from medallion import session
from medallion.sources import avro
from workload import queries
from workload.queries import Inputs

SF = "/root/testdata/sf0.01"


def _bytes(folder: str) -> int:
    return sum(os.path.getsize(os.path.join(base, f))
               for base, _, files in os.walk(folder) for f in files)


def _left(root: str, old: set[str]) -> set[str]:
    """Shuffle files that stay; Spark removes them in the background."""
    until = time.time() + 10
    while (files := set(glob.glob(f"{root}/**/shuffle_*.data", recursive=True)) - old) and (
            time.time() < until):
        time.sleep(0.1)
    return files


@pytest.fixture
def scratch(spark, tmp_path, monkeypatch):
    """All stored results in one folder."""
    def scratch_dir(spark, purpose):
        return f"{tmp_path}/{purpose}-{uuid.uuid4().hex}"

    for module in (queries, session, avro):
        monkeypatch.setattr(module, "scratch_dir", scratch_dir)
    return str(tmp_path)


def test_sinks_take_a_few_times_the_table(spark, scratch):
    rows = queries._sink_roundtrip(Inputs(spark, SF)).collect()
    assert {r.format: r.row_count for r in rows} == dict.fromkeys(
        ("csv", "parquet", "json", "avro"), 60_000)
    stored = sum(_bytes(f"{scratch}/{d}") for d in os.listdir(scratch) if "settled" in d)
    assert _bytes(scratch) < 10 * stored


def test_sources_and_their_lines_are_packed(spark, scratch):
    i = Inputs(spark, SF)
    assert {r.table_name: r.row_count for r in queries._ingest_all(i).collect()}[
        "refugee_assistance"] == 60_000
    of = {kind: sum(_bytes(f"{scratch}/{d}") for d in os.listdir(scratch) if d.startswith(kind))
          for kind in ("lake", "sources", "avro-lines")}
    assert of["sources"] + of["avro-lines"] < 2.5 * of["lake"]


def test_cleaning_checks_keep_no_shuffle_files(spark):
    """One table is checked after the other, and its files go with it."""
    root = os.environ.get("SPARK_LOCAL_DIRS", spark.conf.get(
        "spark.local.dir", tempfile.gettempdir()))
    old = set(glob.glob(f"{root}/**/shuffle_*.data", recursive=True))
    found = queries._clean_invariants(Inputs(spark, "/root/testdata/sf0.001"))
    assert len(found.collect()) == 9
    assert not _left(root, old)
    assert "Exchange" not in plan_of(found)
