"""Exact deduplication by sorting content.

Rows are range-partitioned by sampled splitters and sorted externally, so equal texts
lie next to each other; neighbours are compared in full and one row of each run
stays.  The splitters are built on a short key (the text's first bytes and its
64-bit hash), which keeps the sample that Spark fetches small however long texts are;
the full text decides inside a partition.

A text shared by very many rows would fill one partition, so the range key also
has a lane, a hash of the row's key.  A run is cut into at most ``rows /
lane_rows`` pieces; each piece names its best row, and the pieces of a text, now
one short row each, are settled by their SHA-256.

Edge cases: NULL counts as the empty text; a NULL key loses against any other;
rows repeated with their key count in ``group_size`` and one of them stays; other
columns pass through, and result names that exist get underscores in front; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import free_names, quoted, store, text_of


RANGE_BYTES = 128 << 20  # of text in a range partition


def sorted_runs(docs: DataFrame, key: str, normal: Column, carry: list[Column], keep: str,
                lane_rows: int) -> DataFrame:
    """``carry`` plus per row: ``sha``, ``lane``, ``nth`` of its piece, and the piece's
    ``head`` key and ``n`` rows.  One range shuffle of the texts."""
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(normal))).first()
    lanes = max(1, -(-rows // lane_rows))
    id_ = F.col(quoted(key))
    placed = docs.select(
        *carry, id_.alias("_key"), normal.alias("_content")
    ).withColumns({
        "_front": F.substring(F.col("_content"), 1, 16),
        "_hash": F.xxhash64("_content"),
        "_lane": F.pmod(F.xxhash64(F.col("_key")), F.lit(lanes))})
    # adaptive execution does not split a range number that is given: it follows the input
    width = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                -(-(size or 0) // RANGE_BYTES))
    range_key = ["_front", "_hash", "_lane"]
    placed = placed.repartitionByRange(width, *range_key)
    # partitioned by the range key already: the window adds a sort, not a shuffle
    piece = Window.partitionBy("_front", "_hash", "_content", "_lane")
    best = F.col("_key").desc_nulls_last() if keep == "largest" \
        else F.col("_key").asc_nulls_last()
    return placed.withColumns({
        "_nth": F.row_number().over(piece.orderBy(best)),
        "_head": F.first("_key").over(piece.orderBy(best)),
        "_n": F.count(F.lit(1)).over(piece),
    }).withColumn("_sha", F.sha2(F.col("_content").cast("binary"), 256)).drop(
        "_front", "_hash", "_content")


def _settled(pieces: DataFrame, keep: str) -> DataFrame:
    """Per piece: the group's kept key and size, and whether the piece holds the kept row."""
    group = Window.partitionBy("_sha")
    best = F.col("_head").desc_nulls_last() if keep == "largest" \
        else F.col("_head").asc_nulls_last()
    order = group.orderBy(best, "_lane")
    return pieces.select(
        F.col("_sha").alias("_g_sha"), F.col("_lane").alias("_g_lane"),
        F.first("_head").over(order).alias("_keep"),
        F.sum("_n").over(group).alias("_size"),
        (F.row_number().over(order) == 1).alias("_wins"))


def duplicate_report(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     normal: Column | None = None, keep: str = "largest",
                     lane_rows: int = 20_000) -> DataFrame:
    """One row per document: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``normal`` is the normalised text (default: the text itself).
    """
    normal = text_of(text) if normal is None else normal
    runs = store(sorted_runs(docs, key, normal, [], keep, lane_rows), "content-sort")
    groups = _settled(runs.where("_nth = 1"), keep)
    names = free_names(docs.select(F.col(quoted(key))),
                       "keep_id", "group_size", "kept", "text_sha256")
    joined = runs.join(groups, (F.col("_sha") == F.col("_g_sha"))
                       & (F.col("_lane") == F.col("_g_lane")))
    return joined.select(
        F.col("_key").alias(key), F.col("_keep").alias(names[0]),
        F.col("_size").cast("bigint").alias(names[1]),
        (F.col("_wins") & (F.col("_nth") == 1)).alias(names[2]),
        F.col("_sha").alias(names[3]))


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    normal: Column | None = None, keep: str = "largest",
                    lane_rows: int = 20_000) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns unchanged."""
    normal = text_of(text) if normal is None else normal
    carry = [F.col(quoted(c)).alias(f"_c{i}") for i, c in enumerate(docs.columns)]
    runs = sorted_runs(docs, key, normal, carry, keep, lane_rows)
    heads = store(runs.where("_nth = 1"), "content-heads")
    # only texts in several lanes have a piece that loses
    losers = store(_settled(heads, keep).where("not _wins").select("_g_sha", "_g_lane"),
                   "content-losers")
    kept = heads.join(losers, (F.col("_sha") == F.col("_g_sha"))
                      & (F.col("_lane") == F.col("_g_lane")), "left_anti")
    return kept.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)))
