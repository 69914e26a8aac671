"""Session helpers."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from medallion.session import scratch_dir, settle, shuffle_width


def fake(master, shared):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: shared),
                           sparkContext=SimpleNamespace(master=master))


def test_shared_folder_comes_from_the_session():
    a, b = (scratch_dir(fake("spark://host", "/shared/cp/"), "x") for _ in range(2))
    assert a.startswith("/shared/cp/x-") and a != b


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(fake("spark://host", None), "x")


def test_local_mode_may_use_a_local_folder():
    assert scratch_dir(fake("local[2]", None), "x")


def test_shuffle_width_follows_the_input():
    assert shuffle_width(1) == 8
    assert shuffle_width(128 << 30) == 1024
    assert shuffle_width(100 << 40) == 819_200  # no ceiling


def test_settled_rows_are_the_same_rows(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) as s")
    assert settle(df).exceptAll(df).count() == 0
    empty = df.where("false")
    assert settle(empty).schema.names == ["id", "s"] and settle(empty).count() == 0
