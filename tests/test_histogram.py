"""Histograms against numpy."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from medallion.operators import histogram, histogram_by

DATA = {
    "integers": [random.Random(1).randint(2000, 15000) for _ in range(700)],
    "decimals": [round(random.Random(2).random() * 10, 2) for _ in range(5)] * 3 + [10.0, 0.0],
    "one_value": [7.0] * 9,
    "edges": [float(i) for i in range(51)],
}


@pytest.mark.parametrize("name", DATA)
@pytest.mark.parametrize("bins", [1, 30, 50])
def test_histogram_equals_numpy(spark, name, bins):
    values = [float(v) for v in DATA[name]]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    rows = histogram(df, "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins)
    assert [r.frequency for r in rows] == counts.tolist()
    assert [r.bin_start for r in rows] == pytest.approx(edges[:-1].tolist())
    assert [r.bin_end for r in rows] == pytest.approx(edges[1:].tolist())


def test_histogram_of_nothing_is_empty(spark):
    assert histogram(spark.createDataFrame([], "v double"), "v", 5).collect() == []


def test_each_group_has_its_own_range(spark):
    r = random.Random(5)
    rows = [(g, r.random() * scale) for g, scale in (("a", 1), ("b", 1000)) for _ in range(200)]
    df = spark.createDataFrame([*rows, (None, 1.0), ("a", None)], "g string, v double")
    got = histogram_by(df, "g", "v", 30).collect()
    assert len(got) == 60
    for g in "ab":
        counts, _ = np.histogram([v for k, v in rows if k == g], 30)
        mine = sorted((x for x in got if x.g == g), key=lambda x: x.bin)
        assert [x.frequency for x in mine] == counts.tolist()


def test_nan_is_missing_and_large_equal_values_have_a_bin(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (math.nan,), (None,)], "v double")
    assert sum(r.frequency for r in histogram(df, "v", 3).collect()) == 2
    same = spark.createDataFrame([("a", 1e17), ("a", 1e17)], "g string, v double")
    assert sum(r.frequency for r in histogram(same, "v", 3).collect()) == 2
    assert sum(r.frequency for r in histogram_by(same, "g", "v", 3).collect()) == 2


def test_an_infinite_range_is_an_error(spark):
    df = spark.createDataFrame([(1.0,), (math.inf,)], "v double")
    with pytest.raises(Exception, match="must be finite"):
        histogram(df, "v", 3).collect()
