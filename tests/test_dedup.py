"""Distinct rows by digest."""

from __future__ import annotations

from collections import Counter

import pytest

from medallion.operators import dedup, distinct_by_digest
from medallion.session import settle


def shuffled_bytes(df) -> int:
    """Bytes that all exchanges of a plan wrote, after running it."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        elif node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_copies_nulls_and_odd_doubles(spark):
    nan = float("nan")
    rows = [(1, "a", 0.0), (1, "a", -0.0), (1, None, nan), (1, None, nan), (None, None, None),
            (None, None, None), (2, None, 1.0), (None, "2", 1.0), (3, "", None), (3, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    got = Counter(map(str, distinct_by_digest(df).collect()))
    assert got == Counter(map(str, df.distinct().collect()))
    assert distinct_by_digest(df.limit(0)).count() == 0


@pytest.mark.parametrize("words", [1, 4])
def test_a_filter_that_overflows_changes_nothing(spark, monkeypatch, words):
    monkeypatch.setattr(dedup, "FILTER_WORDS", words)
    df = spark.range(2000).selectExpr("id % 700 as a", "string(id % 1400) as b")
    assert distinct_by_digest(df).exceptAll(df.distinct()).count() == 0
    assert distinct_by_digest(df).count() == df.distinct().count()


def test_columns_that_look_alike(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "`x.y` string, `_w` string")
    assert sorted(map(str, distinct_by_digest(df).collect())) == sorted(
        map(str, df.distinct().collect()))


def test_only_digests_are_shuffled_when_few_rows_repeat(spark):
    wide = settle(spark.range(20_000).selectExpr(
        "id", "sha2(string(id), 512) as a", "sha2(string(id + 1), 512) as b",
        "sha2(string(id + 2), 512) as c", "sha2(string(id + 3), 512) as d"))
    few = settle(wide.unionByName(wide.where("id < 20")))
    by_digest = shuffled_bytes(distinct_by_digest(few))
    assert distinct_by_digest(few).count() == 20_000
    assert by_digest < 20_020 * 40 < shuffled_bytes(few.distinct()) / 5


def test_a_third_of_the_rows_equal(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 0, id) as a", "if(id % 3 = 0, 'x', 'y') as b")
    out = distinct_by_digest(df)
    assert out.count() == 6001 and out.where("a = 0").count() == 1
