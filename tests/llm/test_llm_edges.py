"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

from collections import Counter

import pytest
from llm_tables import LONG, ODD_ROWS, PLAIN, documents
from pyspark.sql import functions as F

from medallion.llm import (
    content_sort,
    decontaminate,
    ngram_join,
    pieces,
    quality_mil,
    sharding,
    simhash,
    suffix_tree,
    token_counts,
    toxicity,
)
from medallion.llm.queries import model_path


def benchmark_of(spark):
    return spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog and runs far"), (2, None), (None, "one"),
         (3, ""), (4, "word1 tail")], "item_id bigint, text string")


KEEPING = {
    "token_counts": lambda d, l: token_counts.count_tokens(d, model_path()),
    "suffix_tree": lambda d, l: suffix_tree.score_texts(d),
    "simhash": lambda d, l: simhash.near_duplicates(d),
    "ngram_join": lambda d, l: ngram_join.near_duplicates(d),
    "pieces": lambda d, l: pieces.piece_digests(d, model_path()),
    "pieces_full": lambda d, l: pieces.encode_pieces(d, model_path()),
    "toxicity": lambda d, l: toxicity.score_toxicity(d, toxicity.learn(d, l)),
    "quality": lambda d, l: quality_mil.score_quality(d, quality_mil.learn(d, l)),
    "spans": lambda d, l: decontaminate.decontaminate(
        d, benchmark_of(d.sparkSession), remove="spans"),
}


@pytest.mark.parametrize("name", KEEPING)
def test_every_row_and_column_stays(name, odd, labels):
    out = KEEPING[name](odd, labels)
    assert len(set(map(str.lower, out.columns))) == len(out.columns)
    assert out.columns[:len(odd.columns)] == odd.columns
    others = [c for c in odd.columns if name != "spans" or c != "text"]
    assert Counter(map(tuple, out.select(*others).collect())) == Counter(
        map(tuple, odd.select(*others).collect()))
    new = out.columns[len(odd.columns):]
    assert out.where(" or ".join([f"`{c}` is null" for c in new if c.lstrip("_") not in (
        "component_id",)] or ["false"])).count() == 0


@pytest.mark.parametrize("name", KEEPING)
def test_empty_table(name, none, labels):
    assert KEEPING[name](none, labels).count() == 0


DROPPING = {
    "toxic": lambda d, l: toxicity.drop_toxic(d, l),
    "copies": lambda d, l: content_sort.drop_duplicates(d),
    "near copies": lambda d, l: simhash.drop_near_duplicates(d),
    "contaminated": lambda d, l: decontaminate.decontaminate(d, benchmark_of(d.sparkSession)),
}


@pytest.mark.parametrize("name", DROPPING)
def test_filters_keep_columns_and_survive_empty_tables(name, odd, none, labels):
    out = DROPPING[name](odd, labels)
    assert out.schema.names == odd.schema.names
    kept = Counter(map(tuple, out.collect()))
    assert not kept - Counter(map(tuple, odd.collect()))
    assert DROPPING[name](none, labels).count() == 0


def test_copies_leave_one_row_per_text(odd):
    texts = [r["text"] or "" for r in content_sort.drop_duplicates(odd).collect()]
    assert sorted(texts) == sorted({t or "" for _, t in ODD_ROWS})


def test_copies_split_into_lanes_agree(odd, spark):
    rows = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, "same").otherwise(
        F.concat(F.lit("t"), (F.col("id") % 50).cast("string"))).alias("text"))
    many = content_sort.duplicate_report(rows, "id", lane_rows=7)
    one = content_sort.duplicate_report(rows, "id")
    assert sorted(many.collect()) == sorted(one.collect())
    assert many.where("kept").count() == rows.select("text").distinct().count()
    left = content_sort.drop_duplicates(rows, "id", lane_rows=7)
    assert {r["id"] for r in left.collect()} == {
        r["id"] for r in many.where("kept").collect()}
    least = content_sort.duplicate_report(rows, "id", keep="smallest", lane_rows=7)
    assert {r["keep_id"] for r in least.collect()} == {
        r[0] for r in rows.groupBy("text").agg(F.min("id")).select("min(id)").collect()}


def test_near_copies_leave_one_row_per_component(odd):
    out = simhash.drop_near_duplicates(odd)
    found = simhash.near_duplicates(odd)
    assert out.count() == found.select(found.columns[-2]).distinct().count()


def test_a_key_of_several_texts_leaves_one_row_per_component(spark):
    far = "an entirely different text about ships that sail to distant harbours at night"
    texts = [f"{w} {PLAIN} {w} {far} {w}" for w in ("one", "two", "three")]
    docs = documents(spark, [(1, PLAIN), (1, far), (1, far), (1, texts[0]), (5, far)])
    out = simhash.drop_near_duplicates(docs)
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == sorted(
        [(1, PLAIN), (1, far), (1, texts[0])])


def test_linked_fingerprints_of_null_keys_leave_one_row(spark, monkeypatch):
    prints = {"a": 0b1, "b": 0b11, "c": 0b111, "d": 0xFF00FF00}

    def numbers(text, shingle=3):
        return F.create_map(*(F.lit(x) for p in prints.items() for x in p))[text].cast("bigint")

    monkeypatch.setattr(simhash, "fingerprints", numbers)
    docs = documents(spark, [(None, "a"), (None, "b"), (None, "c"), (None, "d"), (None, "d")])
    rows = [r["text"] for r in simhash.drop_near_duplicates(docs).collect()]
    assert len(rows) == 2 and "d" in rows
    docs = documents(spark, [(None, "a"), (7, "b"), (8, "c")])
    assert [r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()] == [7]


@pytest.mark.parametrize("links", [[(1, 2), (1, 3)], [(3, 1), (2, 1)], [(5, 4)], [],
                                   [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7)]])
def test_components_name_each_node_once(spark, links):
    edges = spark.createDataFrame(links, "a bigint, b bigint")
    got = sorted(tuple(r) for r in simhash.components(edges).select("node", "root").collect())
    nodes = sorted({n for e in links for n in e})
    least = {n: 7 if n > 6 else min(nodes) for n in nodes}
    assert got == [(n, least[n]) for n in nodes]


def test_contamination_of_odd_rows(odd, spark, none):
    out = {(r["doc_id"], r["n_words"]): r for r in decontaminate.contamination_report(
        odd.select("doc_id", "text"), benchmark_of(spark)).collect()}
    assert out[1, 16]["n_hit"] == 11 and out[1, 16]["n_items"] == 1
    assert out[3, 0]["contaminated"] is False and out[4, 0]["n_hit"] == 0
    assert out[9, 1]["contaminated"] and out[9, 1]["n_items"] == 0  # an item without an id
    assert out[7, 24_000]["n_items"] == 1
    empty = spark.createDataFrame([], "item_id bigint, text string")
    report = decontaminate.contamination_report(odd.select("doc_id", "text"), empty)
    assert report.where("contaminated").count() == 0
    # same result when the table of windows is joined by shuffle
    joined = decontaminate.contamination(
        odd.select("doc_id", "text"), benchmark_of(spark), broadcast_rows=0)
    sent = decontaminate.contamination(odd.select("doc_id", "text"), benchmark_of(spark))
    assert sorted(joined.select("_key", "n_hit").collect(), key=str) == sorted(
        sent.select("_key", "n_hit").collect(), key=str)


def test_the_report_has_a_row_for_every_document(odd, spark):
    docs = odd.select("doc_id", "text").unionByName(
        spark.createDataFrame([(None, None), (1, PLAIN)], "doc_id bigint, text string"))
    report = decontaminate.contamination_report(docs, benchmark_of(spark))
    assert Counter(r["doc_id"] for r in report.collect()) == Counter(
        r["doc_id"] for r in docs.collect())
    assert report.where("doc_id = 2 and n_hit = 11").count() == 2


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame(
        [(1, "Start: quick BROWN fox jumps over the lazy dog, and runs far... end!"),
         (2, "clean text")], "doc_id bigint, text string")
    out = decontaminate.decontaminate(docs, benchmark_of(spark), remove="spans")
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        1: "Start: end!", 2: "clean text"}


def test_long_texts_are_learned_whole(spark):
    sample = spark.createDataFrame(
        [(1, 1, LONG), (2, 0, PLAIN), (3, 0, PLAIN)], "_id bigint, _y int, _text string")
    bags, y = quality_mil.sampled_bags(sample, 64 << 20)
    assert [len(b) for b in bags] == [24_000 // quality_mil.PASSAGE, 1, 1] and list(y) == [1, 0, 0]
    few, y = quality_mil.sampled_bags(sample, 200)  # fewer rows, not fewer passages
    assert sorted(map(len, few)) == [1, 24_000 // quality_mil.PASSAGE] and sorted(y) == [0, 1]


def test_shards_of_odd_rows(odd, none):
    rows = sharding.assign_shards(odd.select("doc_id", "text"), shards=4).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == len(ODD_ROWS) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {16}
    assert sharding.assign_shards(none.select("doc_id", "text")).count() == 0


def test_shards_on_disk_hold_whole_records(odd, spark, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(odd, path, shards=3, bucket_bytes=1000)
    back = spark.read.parquet(path).select(*odd.columns)
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, odd.collect()))


def test_reported_places_are_those_of_the_files(spark, tmp_path):
    docs = documents(spark, [*ODD_ROWS, *((i, f"text {i}") for i in range(100, 400))],
                     extra=("shard", "Slot"))
    path = str(tmp_path / "shards")
    got = sharding.shard_report(docs, path, shards=5, bucket_bytes=20_000)
    want = sharding.assign_shards(docs.repartition(3), shards=5, bucket_bytes=20_000)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    sizes = Counter(r["shard"] for r in got.collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    back = sharding.read_shards(docs, path)
    assert Counter(map(tuple, back.select(*docs.columns).collect())) == Counter(
        map(tuple, docs.collect()))
    assert len(list((tmp_path / "shards").glob("_shard=*"))) == 5
    assert got.inputFiles() and all(path in f for f in got.inputFiles())
