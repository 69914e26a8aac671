"""Filter audit, n-gram join and hard negatives against plain definitions and odd tables."""

from __future__ import annotations

import math
import random
from collections import Counter

import brute
import numpy as np
import pytest
from llm_tables import ODD_ROWS, documents
from pyspark.sql import functions as F

from medallion.llm import filter_audit, hard_negatives, ngram_join

STEPS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audited(docs, labels):
    rows = filter_audit.audit(docs, labels).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in STEPS) for r in rows}
    assert len(found) == len(rows)
    return found


def test_audit_of_odd_rows(spark, odd, labels):
    wide = " ".join(f"Word{i}" for i in range(60))
    rows = [*ODD_ROWS, (20, wide), (21, wide), (21, wide), (22, wide + " #"), (23, "50% off")]
    docs = documents(spark, rows).drop("source").withColumn("source", F.expr(
        "case when doc_id % 3 = 0 then 'a' when doc_id % 3 = 1 then '' end"))
    plain = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    marks = labels.unionByName(spark.createDataFrame(
        [(21, 1, 0), (21, 0, 1), (99, 1, 1)], labels.schema))
    want = brute.audit(plain, [tuple(r) for r in marks.collect()])
    assert audited(docs, marks) == want
    assert len(want) == 2 * 600  # a NULL part is the part ''


def test_audit_of_empty_tables(none, odd, labels, spark):
    assert audited(none, labels) == {}
    some = audited(odd, spark.createDataFrame([], labels.schema))
    assert len(some) == 600 and all(v[4] == v[5] == 0 for v in some.values())


def test_audit_of_other_filters(spark):
    """Two filters without the one for copies; each order's steps sum to all removals."""
    docs = spark.createDataFrame([(i, "x" * i, "s") for i in range(10)],
                                 "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(9, 1, 0)], "doc_id bigint, quality int, toxic int")
    size = F.length("text")
    rows = filter_audit.audit(docs, labels, {"S": size < 3, "T": (size < 5) | (size > 8)},
                              duplicates=None).collect()
    got = {(r["filter_order"], r["step"]): (r["removed"], r["good_lost"], r["shapley"])
           for r in rows}
    assert got == {("ST", 1): (3, 0, 3), ("ST", 2): (3, 1, 9),
                   ("TS", 1): (6, 1, 9), ("TS", 2): (0, 0, 3)}


def joined(docs, **kw):
    return Counter(map(tuple, ngram_join.near_duplicates(docs, carry=["doc_id"], **kw).collect()))


def test_join_of_odd_rows(odd, none):
    want = Counter(brute.jaccard_components(ODD_ROWS))
    assert joined(odd) == want
    assert joined(none) == Counter()


def _varied(rng, base, changes):
    w = base[:]
    for _ in range(changes):
        at = rng.randrange(len(w) + 1)
        w[at:at + rng.randrange(2)] = [f"new{rng.randrange(10**6)}"] * rng.randrange(2)
    return w


@pytest.mark.parametrize("seed", range(2))
def test_join_finds_every_component(spark, seed):
    """Groups around the threshold, chains, a passage in every text, tiny texts, copies."""
    rng, texts = random.Random(seed), []
    passage = [f"common{i}" for i in range(60)]
    for size in (3, 8, 9, 10, 11, 12, 14, 20, 40, 100, 250, 700, 1500):
        for _ in range(3):
            base = [f"w{rng.randrange(10**7)}" for _ in range(size)]
            if rng.random() < .5:
                base += passage
            chain = base
            for step in range(6):
                texts.append(" ".join(_varied(rng, base, step * size // 60)))
                chain = _varied(rng, chain, max(1, size // 70))
                texts.append(" ".join(chain))
            texts.append(" ".join(base).upper())
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = Counter(brute.jaccard_components(rows))
    assert len({c for _, _, c in want}) < len(texts)
    assert joined(docs) == want


def test_join_at_the_exact_threshold(spark):
    """18 of 20 n-grams in common link, as do 9 of 10; less does not."""
    w = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(w[:20])), (2, " ".join(w[:22])), (3, " ".join(w[:23])),
            (4, " ".join(w[20:31])), (5, " ".join(w[20:32])), (6, "a b"), (7, "A B"), (8, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {k: c for k, _, c in joined(docs)}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8}
    assert joined(docs) == Counter(brute.jaccard_components(rows))


def test_pairs_that_agree_only_in_empty_blocks_are_listed():
    """Whatever the n-grams, two sets within the bound share a listed block."""
    bounds, rng = ngram_join.Bounds(9, 10), np.random.default_rng(5)
    for _ in range(4000):
        size = int(rng.integers(9, 40))
        # few leading bits: uneven blocks, many of them empty
        a = np.unique(rng.integers(0, 1 << 62, size, dtype=np.uint64)
                      | np.uint64(int(rng.integers(0, 4)) << 62))
        most = bounds.difference(2 * len(a))
        b = np.unique(np.concatenate([
            a[rng.permutation(len(a))[:len(a) - most // 2]],
            rng.integers(0, 1 << 64, most // 2, dtype=np.uint64)]))
        if bounds.linked(a, b) and len(a) != len(b) or most > 1:
            if bounds.linked(a, b) and not np.array_equal(a, b):
                assert np.intersect1d(bounds.listed(a), bounds.listed(b)).size


def test_overlap_by_column_blocks(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMN_BLOCK", 4)
    bounds, rng = ngram_join.Bounds(9, 10), np.random.default_rng(1)
    for _ in range(500):
        a = np.unique(rng.integers(0, 300, 200).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < .97], rng.integers(
            0, 300, 3).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        assert bounds.overlap(a, b) in (common, -1)
        assert bounds.linked(a, b) == (10 * common >= 9 * (len(a) + len(b) - common))


def test_a_group_of_near_copies_lists_few_pairs(spark, monkeypatch):
    """Pairs inside a component that is known are not compared."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1:]) for i in rng.sample(range(300), 150)]
    seen = []
    checked = ngram_join._checked

    def counted(pairs, grams, bounds):
        seen.append(pairs.count())
        return checked(pairs, grams, bounds)

    monkeypatch.setattr(ngram_join, "_checked", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {c for _, _, c in joined(docs)} == {0}
    assert sum(seen) < 150 * 30 < 150 * 149 / 2  # a few centres for each text


def vectors(spark, rows):
    return spark.createDataFrame(
        rows, "vec_id bigint, embedding array<float>, label int, anchor string, top string")


def mined(df, **kw):
    out = hard_negatives.mine_hard_negatives(df, is_anchor=F.col("id") % 10 == 0, **kw)
    return sorted(map(tuple, out.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score",
        "negative_score").collect()))


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), math.inf
    rows = [(1, None, 1), (2, [0.5, None], 1), (3, [nan, 1.0], 1), (4, [inf, 0.0], 0),
            (None, [1.0, 1.0], 1), (5, [1.0, 0.5], None), (10, [1.0, 0.5], 1), (20, [], 1),
            (11, [1.0, 0.25], 1), (12, [1.0, 0.25], 1), (12, [1.0, 0.25], 1), (13, [0.75], 0),
            (14, [0.75, 0.25], 0), (14, [0.75, 0.25], 2), (10, [0.5, 0.5], 2), (15, [-1.0, 0.1], 1),
            (30, [1.0, 0.0, 0.0], 7), (16, [3e38, -3e38], 3)]
    df = vectors(spark, [(*r, "x", "y") for r in rows])
    capped = [(i, v if v is None else [None if x is None else min(65536, max(-65536, x))
                                       if math.isfinite(x) else x for x in v], c)
              for i, v, c in rows]
    # a shorter vector counts as zero where it ends; so does zip
    assert mined(df) == brute.hard_negatives(capped, lambda i: i % 10 == 0)
    assert mined(df.limit(0)) == []


@pytest.mark.parametrize("seed", range(2))
def test_negatives_with_ties_in_small_blocks(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.5, -0.25, 0.0, 0.25, 0.5, 0.75]) for _ in range(20)],
             rng.choice([0, 0, 0, 1, 2])) for i in range(400)]
    want = brute.hard_negatives(rows, lambda i: i % 10 == 0)
    df = vectors(spark, [(*r, "x", "y") for r in rows])
    assert want and mined(df, block_rows=64, group_rows=7) == want


def test_vertical_scan_drops_rows_early():
    """Rows far below the wanted ones leave before all columns are read."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    centre = rng.normal(size=64) * 200
    near, far = rng.normal(size=(20, 64)) * 5 + centre, rng.normal(size=(980, 64)) * 5 - centre
    rows = np.rint(np.concatenate([near, far])).astype(int).tolist()
    table = pa.table({"id": range(1000), "label": [1] * 1000, "v": rows})
    block, asked = hard_negatives.Block(table, 64), []

    def drop(low, high):
        asked.append(len(low))
        return high >= hard_negatives.nth_largest(low, 5)

    at, scores = hard_negatives.scan(block, slice(0, 1000), np.array(rows[0]), drop)
    exact = np.array(rows) @ np.array(rows[0])
    assert (scores == exact[block.id[at]]).all()
    assert set(np.argsort(-exact)[:5]) <= set(block.id[at].tolist())
    assert asked[0] == 1000 and asked[-1] < 30
