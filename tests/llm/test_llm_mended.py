"""Long texts, repeated records, odd chat records: cases that earlier versions got wrong."""

from __future__ import annotations

import json
import time
from collections import Counter

import brute
import pytest
from llm_tables import ODD_ROWS, documents
from pyspark.sql import functions as F

from medallion.llm import chat_format, content_sort, decontaminate, sharding


# --- sharding -----------------------------------------------------------------------------

def test_a_repeated_record_fills_no_bucket(spark):
    """A third of the rows are one record; buckets stay near their mean."""
    docs = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    rows = sharding.numbered(docs.select(F.xxhash64("doc_id", "text").alias("_h"), "doc_id"))
    again = rows.where("doc_id = -7").agg(
        F.count("*"), F.count_distinct("_nth"), F.min("_nth"), F.max("_nth")).first()
    assert tuple(again) == (10_000, 10_000, 0, 9_999)
    sizes = [r["count"] for r in rows.groupBy(F.pmod(F.xxhash64("_h", "_nth"), F.lit(
        30))).count().collect()]
    assert len(sizes) == 30 and max(sizes) < 1.2 * sorted(sizes)[15]
    out = sharding.assign_shards(docs, shards=7, bucket_bytes=40_000)
    got = Counter(r["shard"] for r in out.collect())
    assert max(got.values()) - min(got.values()) <= 1 and sum(got.values()) == 30_000
    # the order does not depend on how rows were dealt
    other = sharding.assign_shards(docs.repartition(5), shards=7, bucket_bytes=40_000)
    assert out.exceptAll(other).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 9, 300])
def test_fisher_yates(spark, n):
    """The permutation is that of the same draws in plain Python."""
    df = spark.range(1).select(
        sharding.fisher_yates(F.lit(n), lambda i: F.xxhash64(F.lit(5), i)).alias("p"),
        F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.pmod(
            F.xxhash64(F.lit(5), i), i + 1)).alias("draws"))
    row = df.first()
    want = []
    for i, j in enumerate(row["draws"][:n]):
        want.append(i)
        want[j], want[i] = want[i], want[j]
    assert row["p"] == want and sorted(row["p"]) == list(range(n))


def test_every_order_of_a_bucket_is_equally_likely(spark):
    orders = spark.range(6000).select(sharding.fisher_yates(
        F.lit(3), lambda i: F.xxhash64(F.lit(1), "id", i)).alias("p")).groupBy("p").count()
    found = {tuple(r["p"]): r["count"] for r in orders.collect()}
    assert len(found) == 6 and all(850 < c < 1150 for c in found.values())


def test_files_follow_the_bytes(spark, tmp_path, monkeypatch):
    """Few tasks, so few files, however many shards; a task writes neighbouring shards."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x" * 100).alias("text"))
    monkeypatch.setattr(sharding, "RUN_BYTES", 100_000)
    path = str(tmp_path / "shards")
    sharding.write_shards(docs.repartition(8), path, shards=3, bucket_bytes=20_000)
    files = list((tmp_path / "shards").glob("shard=*/*.parquet"))
    assert len(files) <= 2 * -(-4000 * 116 // 100_000) + 3
    assert sharding.read_shards(docs, path).count() == 4000


# --- decontamination ----------------------------------------------------------------------

def _bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_windows_across_blocks(spark):
    """Passages at every offset, short items, items of exactly the window, joined or sent."""
    words = [f"w{i}" for i in range(170)]
    bench = [(1, " ".join(words[40:60])), (2, " ".join(words[95:105])), (3, "w47 w48"),
             (4, "w169"), (5, " ".join(words[:10])), (6, "w48"), (7, " ".join(words[140:165]))]
    texts = [(i, " ".join(["pad"] * i + words)) for i in (0, 1, 7, 38, 39, 40, 47, 48, 49)]
    texts += [(100, " ".join(words[40:49])), (101, "w48 " * 200), (102, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    for limit in (0, 2_000_000):
        found = decontaminate.contamination(docs, _bench(spark, bench), broadcast_rows=limit)
        got = {r["_key"]: (r["n_words"], r["n_hit"], sorted(map(str, r["items"])))
               for r in found.collect()}
        assert got == {i: brute.contamination(t, bench) for i, t in texts}


def test_time_grows_with_the_length_of_a_text(spark):
    """Ten times the words within twice the time a word (with a floor for what any job takes)."""
    bench = _bench(spark, [(1, "a b c d e f g h i j k")])

    def seconds(words):
        docs = spark.createDataFrame(
            [(1, " ".join(f"v{i % 5003}" for i in range(words)))], "doc_id bigint, text string")
        start = time.time()
        assert decontaminate.contamination_report(docs, bench).first()["n_words"] == words
        return time.time() - start

    seconds(1000)
    floor = min(seconds(1000) for _ in range(2))
    small, large = seconds(50_000), seconds(500_000)
    assert large - floor < 20 * max(small - floor, 0.25)


def test_spans_of_long_texts_are_cut_out(spark):
    """Overlapping, adjoining and distant passages; the rest stays byte for byte."""
    passage = "one two three four five six seven eight nine ten eleven"
    bench = _bench(spark, [(1, passage), (2, "alpha beta")])
    text = (f"Start, {passage.upper()}; mid  dle\n alpha, beta! " + "x " * 300
            + f"{passage} alpha beta end.")
    docs = spark.createDataFrame([(1, text), (2, "Alpha beta"), (3, "no hit")],
                                 "doc_id bigint, text string")
    out = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(
        docs, bench, remove="spans").collect()}
    assert out == {1: "Start, mid  dle\n " + "x " * 300 + "end.", 2: "", 3: "no hit"}


# --- chat formatting ------------------------------------------------------------------------

def test_records_with_nulls_and_empty_lists_keep_their_turns(spark):
    records = {
        '{"prompt":null,"response":"x"}': [("user", ""), ("assistant", "x")],
        '{"messages":[{"role":"user","content":null},{"role":null,"content":"b"}]}':
            [("user", ""), ("", "b")],
        '{"messages":[{"role":"user"},{"role":"assistant","content":"c"}]}':
            [("user", ""), ("assistant", "c")],
        '{"messages":[]}': [],
        '{"conversations":[{"from":"human","value":null}]}': [("user", "")],
        '{"instruction":"i","input":null,"output":null}': [("user", "i"), ("assistant", "")],
        '{"messages":null}': None, '{"other":1}': None, "no json": None, "": None, None: None,
    }
    rows = [(k, r) for k, r in enumerate(records)]
    df = spark.createDataFrame(rows, "id int, record string")
    out = {r["record"]: r["turns"] for r in chat_format.canonical_json(df, "record").collect()}
    assert {k: None if v is None else [tuple(t) for t in v] for k, v in out.items()} == records


def test_chat_columns_with_clashing_names(spark):
    df = spark.createDataFrame(
        [(json.dumps({"prompt": "p", "response": "r"}), "a", "b", "c", "d", "e")],
        "record string, turns string, formatted string, Loss_spans string, _pieces string, "
        "_record0 string")
    with_turns = chat_format.canonical_json(df, "record")
    assert with_turns.columns == [*df.columns, "_turns"]
    out = chat_format.format_turns(with_turns, turns="_turns")
    row = out.first()
    assert tuple(row)[:6] == tuple(df.first())
    assert out.columns[-2:] == ["_formatted", "_loss_spans"]
    assert row["_formatted"] == "<|im_start|>user\np<|im_end|>\n<|im_start|>assistant\nr<|im_end|>\n"
    back = out.select(chat_format.read_turns(F.col("_formatted"))).first()[0]
    assert [tuple(t) for t in back] == [("user", "p"), ("assistant", "r")]


def test_chat_of_empty_tables(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat_format.format_turns(chat_format.canonical_table(none, "conv_id")).count() == 0
    records = spark.createDataFrame([], "record string")
    assert chat_format.format_turns(chat_format.canonical_json(records, "record")).count() == 0


# --- exact dedup ---------------------------------------------------------------------------

def test_duplicate_report_of_odd_and_empty_tables(odd, none):
    out = content_sort.duplicate_report(odd)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    groups = Counter(t or "" for _, t in ODD_ROWS)
    assert sorted(r["group_size"] for r in out.collect()) == sorted(
        groups[t or ""] for _, t in ODD_ROWS)
    assert out.where("kept").count() == len(groups)
    assert content_sort.duplicate_report(none).count() == 0


def test_range_partitions_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(content_sort, "RANGE_BYTES", 2_000)
    docs = documents(spark, [(i, f"{i:04d} " + "x" * 95) for i in range(1000)])
    runs = content_sort.sorted_runs(docs, "doc_id", F.col("text"), [], "largest", 10_000)
    assert runs.rdd.getNumPartitions() >= 50
    assert content_sort.drop_duplicates(docs).count() == 1000


