"""Distributed ordering operators against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F
from plans import plan_of

from medallion.operators import ntile_global, number_rows, ordering, running_total


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def expected_tiles(rows, k):
    def key(r):
        v = r[1]
        rank = (2, 0.0) if v is None else (1, 0.0) if math.isnan(v) else (0, v)
        return (rank, md5(r[0]), r[0])
    ordered = sorted(rows, key=key)
    size, extra = divmod(len(rows), k)
    out, at = {}, 0
    for tile in range(1, k + 1):
        n = size + (tile <= extra)
        for r in ordered[at:at + n]:
            out[r[0]] = tile
        at += n
    return out


CASES = {
    "distinct": lambda r, i: r.random() * 100,
    "two_decimals": lambda r, i: round(r.random() * 10, 2),
    "third_on_one_value": lambda r, i: 5.0 if i % 3 == 0 else r.random() * 10,
    "one_value": lambda r, i: 1.0,
    "all_null": lambda r, i: None,
    "nulls_and_nan": lambda r, i: None if i % 4 == 0 else math.nan if i % 5 == 0 else r.random(),
    "infinities": lambda r, i: math.inf if i % 7 == 0 else -math.inf if i % 5 == 0 else r.random(),
    "heavy_tail": lambda r, i: math.exp(r.random() * 40),
    "negative": lambda r, i: r.gauss(0, 1),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("n,k,cuts", [(500, 10, 7), (97, 10, 1023), (5, 10, 15)])
def test_ntile_equals_sequential_ntile(spark, name, n, k, cuts):
    r = random.Random(n)
    rows = [(f"id{i}", CASES[name](r, i)) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, v double").repartition(5)
    got = {x.id: x.tile for x in ntile_global(df, k, "v", "id", "tile", cuts).collect()}
    assert got == expected_tiles(rows, k)


def test_ntile_of_nothing(spark):
    df = spark.createDataFrame([], "id string, v double")
    assert ntile_global(df, 10, "v", "id", "tile").collect() == []


@pytest.mark.parametrize("kind", ["bigint", "date", "timestamp", "string", "decimal(20,4)"])
def test_ntile_orders_by_any_type(spark, kind):
    n = F.col("id")
    value = {
        "bigint": F.when(n % 3 == 0, F.lit(1 << 60)).otherwise(F.lit(1 << 60) + n % 7),
        "date": F.date_add(F.lit("2024-01-01"), (n % 9).cast("int")),
        "timestamp": F.timestamp_millis(n % 11 * 1000),
        "string": F.concat(F.lit("common front "), (n % 13).cast("string")),
        "decimal(20,4)": (n % 17 / 3).cast("decimal(20,4)")}[kind]
    df = spark.range(500).select(
        F.col("id").cast("string").alias("id"),
        F.when(n % 29 > 0, value).cast(kind).alias("v"))
    rows = sorted(df.collect(), key=lambda r: (r.v is None, r.v if r.v is not None else 0,
                                               md5(r.id), r.id))
    got = {r.id: r.tile for r in ntile_global(df, 7, "v", "id", "tile", cuts=5).collect()}
    sizes = [500 // 7 + (i < 500 % 7) for i in range(7)]
    want = [t + 1 for t, size in enumerate(sizes) for _ in range(size)]
    assert [got[r.id] for r in rows] == want


@pytest.mark.parametrize("hot", [1, 10, 10_000])
def test_number_rows_any_hot_limit(spark, hot):
    r = random.Random(3)
    rows = [(f"p{i}", None if i % 3 == 0 else f"b{i % 20}",
             None if i % 11 == 0 else f"2024-01-{r.randint(1, 5):02d}") for i in range(400)]
    df = spark.createDataFrame(rows, "pid string, bid string, day string").withColumn(
        "day", F.col("day").cast("date"))
    got = {x.pid: x.rank for x in number_rows(df, ["bid"], "day", "pid", "rank", hot).collect()}
    groups = {}
    for p, b, d in rows:
        groups.setdefault(b, []).append((p, d))
    for b, members in groups.items():
        members.sort(key=lambda m: (md5(m[0]), m[0]))
        members.sort(key=lambda m: m[1] or "", reverse=True)  # NULL day last
        assert [got[p] for p, _ in members] == list(range(1, len(members) + 1))


def test_running_total_with_null_keys_and_steps(spark):
    rows = [(k, m, d, v) for i, (k, m) in enumerate(
        [("a", "2024-01-01"), ("a", "2024-03-01"), ("a", None), (None, "2024-02-01"), (None, None)])
        for d, v in (("x", 1 + i), ("y", 10 + i), (None, 100 + i))]
    df = spark.createDataFrame(rows, "k string, m string, d string, v long")
    got = {(x.k, x.m, x.d): x.total
           for x in running_total(df, ["k"], ["m", "d"], "v", "total").collect()}
    last = lambda s: (s is None, s or "")
    for key in ("a", None):
        run = 0
        for k, m, d, v in sorted((r for r in rows if r[0] == key),
                                 key=lambda r: (last(r[1]), last(r[2]))):
            run += v
            assert got[k, m, d] == run
    assert len(got) == len(rows)


def test_ntile_plan_sorts_buckets_not_the_table(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("id"),
                             F.rand(1).alias("v")).write.parquet(str(tmp_path / "t"))
    plan = plan_of(ntile_global(spark.read.parquet(str(tmp_path / "t")), 10, "v", "id", "tile"))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the only single-partition exchange is over bucket counts
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert part.lstrip(" ,\n").split("HashAggregate", 1)[1].startswith("(keys=[_bucket")


def test_tiles_of_texts_with_a_long_common_front(spark):
    """Texts are cut where they first differ, so no bucket holds them all."""
    front = "the same long beginning of every text "
    rows = [(f"k{i}", None if i % 50 == 0 else front + f"{i * 7919 % 1000:04d}")
            for i in range(1000)]
    df = spark.createDataFrame([*rows, ("front", front)], "id string, v string")
    got = {r["id"]: r["tile"] for r in ntile_global(df, 8, "v", "id", "tile", cuts=31).collect()}
    order = sorted([*rows, ("front", front)], key=lambda r: (
        r[1] is None, (r[1] or "").encode(), md5(r[0]), r[0]))
    size, extra = divmod(len(order), 8)
    at = 0
    for tile in range(1, 9):
        n = size + (tile <= extra)
        assert {got[r[0]] for r in order[at:at + n]} == {tile}
        at += n
    number, _ = ordering._as_number(df, "v")
    assert df.where("v is not null").select(number).distinct().count() > 900
