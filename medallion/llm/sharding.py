"""Sharding by a two-pass external shuffle.

Pass one scatters records into buckets by a seeded hash; their number follows from the bytes
and rows of the table, so that a bucket fits in a task's memory.  Pass two shuffles each bucket
by Fisher and Yates: the bucket's records, in the order of their hashes, are put one by one at
a place drawn from those so far (the draws are seeded hashes too), and what stood there goes
to the end.  The result depends on neither partitions nor the order of rows.  The buckets laid
end to end are one random order of all records; cut into equal runs it gives shards whose row
counts differ by at most one (law ``rows``).  ``write_shards`` and ``assign_shards`` give a
record the same place.

The scatter hashes key and text, and, for records that are repeated, their number among the
repeated ones.  So neither a NULL key, nor a text shared by a third of all rows, nor one
record repeated as often fills a bucket.  Only records that may be repeated are numbered,
which moves them once more; they are told by a bit filter of fixed size, and numbered per
task and then across tasks.

Neighbouring buckets are shuffled in one task, so a task writes to the one or two shards that
its run of records lies in, and the number of files follows the bytes.

Edge cases: a NULL text has size 16 and the checksum of the empty text; repeated
rows are placed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.common import free_names, quoted, store, text_of
from medallion.operators import mark_repeated

RUN_BYTES = 32 << 20  # of neighbouring buckets that one task shuffles and writes


def record_size(text: str = "text") -> Column:
    return (F.octet_length(text_of(text)) + 16).cast("bigint")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``_nth``, 0 for the only row of its ``_h`` and 0, 1, ... for repeated ones.

    A third of all rows may be one record: rows are numbered inside the task that read them,
    then the tasks' counts are laid end to end.
    """
    marked = mark_repeated(rows, ["_h"], "_again")
    alone = marked.where("not _again").drop("_again").withColumn("_nth", F.lit(0).cast("bigint"))
    again = store(marked.where("_again").drop("_again").withColumn(
        "_task", F.spark_partition_id()), "repeated-records")
    task = Window.partitionBy("_h", "_task")
    inside = again.withColumn("_in", F.row_number().over(task.orderBy("_h")))
    counts = again.groupBy("_h", "_task").agg(F.count(F.lit(1)).alias("_k"))
    before = counts.select(F.col("_h").alias("_bh"), F.col("_task").alias("_bt"), (
        F.sum("_k").over(Window.partitionBy("_h").orderBy("_task")) - F.col("_k")).alias("_b"))
    placed = inside.join(before, (F.col("_h") == F.col("_bh")) & (F.col("_task") == F.col("_bt")))
    return alone.unionByName(placed.select(
        *rows.columns, (F.col("_b") + F.col("_in") - 1).cast("bigint").alias("_nth")))


def fisher_yates(size: Column, draw: Callable[[Column], Column]) -> Column:
    """A permutation of 0 to ``size - 1``; ``draw(i)`` gives a hash for the i-th step."""
    def put(done: Column, x: Column) -> Column:
        i = F.size(done)
        j = F.pmod(draw(i), i + 1).cast("int")
        moved = F.concat(F.slice(done, 1, j), F.array(x), F.slice(done, j + 2, i - j - 1),
                         F.array(F.get(done, j)))
        return F.when(j == i, F.concat(done, F.array(x))).otherwise(moved)

    steps = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(
        F.array().cast("array<int>"))
    return F.aggregate(steps, F.array().cast("array<int>"), put)


def shuffled(docs: DataFrame, columns: dict[str, Column], key: str, text: str, seed: int,
             bucket_bytes: int, bucket_rows: int = 4_096) -> DataFrame:
    """``columns`` of every record plus ``_at``, its place in one random order of all, and
    ``_total``, their number."""
    names = [f"_c{i}" for i in range(len(columns))]
    size, rows = docs.agg(F.sum(record_size(text)), F.count(F.lit(1))).first()
    buckets = max(1, -(-int(size or 0) // bucket_bytes), -(-rows // bucket_rows))
    together = max(1, RUN_BYTES // bucket_bytes)
    record = numbered(docs.select(
        F.xxhash64(F.lit(seed), F.col(quoted(key)), F.xxhash64(text_of(text))).alias("_h"),
        *(c.alias(n) for n, c in zip(names, columns.values()))))
    hashed = F.xxhash64("_h", "_nth")
    scattered = record.select(
        F.pmod(hashed, F.lit(buckets)).alias("_bucket"),
        F.struct(F.xxhash64(F.lit(seed + 1), hashed).alias("_h"), *names).alias("_row")
    ).withColumn("_run", F.floor(F.col("_bucket") / together))
    # buckets that follow each other meet in one task
    listed = scattered.repartition(-(-buckets // together), "_run").groupBy(
        "_run", "_bucket").agg(F.array_sort(F.collect_list("_row"), _by_hash).alias("_rows"))
    order = fisher_yates(F.size("_rows"), lambda i: F.xxhash64(F.lit(seed + 2), "_bucket", i))
    mixed = store(listed.select("_bucket", "_rows", order.alias("_order")).select(
        "_bucket", F.size("_rows").cast("bigint").alias("_n"),
        F.transform("_order", lambda i: F.get("_rows", i)).alias("_rows")), "shuffled-buckets")
    sizes = mixed.select("_bucket", "_n")  # without reading the records
    # stored, so that Spark knows its size when it chooses the join: one short row per bucket
    before = store(sizes.select(
        F.col("_bucket").alias("_b"),
        (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before")),
        "bucket-offsets")
    return mixed.join(before, F.col("_bucket") == F.col("_b")).select(
        "_before", F.posexplode("_rows").alias("_i", "_row")).select(
        (F.col("_before") + F.col("_i")).alias("_at"), F.lit(rows).alias("_total"),
        *(F.col(f"_row.{n}").alias(name) for n, name in zip(names, columns)))


def _by_hash(a: Column, b: Column) -> Column:
    return F.when(a["_h"] < b["_h"], -1).when(a["_h"] > b["_h"], 1).otherwise(0)


def _place(shards: int) -> tuple[Column, Column]:
    """Shard and slot of a place in the order: equal runs, the first ones a row longer."""
    at, few = F.col("_at"), F.floor(F.col("_total") / shards)
    extra = F.col("_total") % shards
    longer = extra * (few + 1)
    shard = F.when(at < longer, F.floor(at / (few + 1))).otherwise(
        extra + F.floor((at - longer) / F.greatest(few, F.lit(1))))
    first = shard * few + F.least(shard, extra)
    return shard.cast("int"), (at - first).cast("bigint")


def _report(rows: DataFrame, key: str, size: Column, crc: Column, shard: Column,
            slot: Column) -> DataFrame:
    return rows.select(
        F.col(quoted(key)), size.alias("size"), crc.alias("text_crc32"),
        F.lit("rows").alias("law"), shard.alias("shard"), slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def text_crc32(text: str) -> Column:
    return F.crc32(text_of(text).cast("binary")).cast("bigint")


def assign_shards(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text",
                  seed: int = 42, bucket_bytes: int = 8 << 20) -> DataFrame:
    """Per record: key, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Only these short columns are moved and nothing is put into a shard; the places are those
    of ``write_shards`` with the same arguments.
    """
    rows = shuffled(
        docs, {"_k": F.col(quoted(key)), "_size": record_size(text), "_crc": text_crc32(text)},
        key, text, seed, bucket_bytes)
    return _report(rows.withColumnRenamed("_k", key), key, F.col("_size"), F.col("_crc"),
                   *_place(shards))


def write_shards(docs: DataFrame, path: str, shards: int = 40, key: str = "doc_id",
                 text: str = "text", seed: int = 42, bucket_bytes: int = 8 << 20) -> None:
    """Write the whole records, one folder ``shard=N`` each, in shuffled order.

    Records of a shard may span files: each task writes its part, with the ``slot`` of
    each record.  Where the table has columns of these names, ours have underscores in front.
    """
    shard, slot = free_names(docs, "shard", "slot")
    columns = {f"_w{i}": F.col(quoted(c)) for i, c in enumerate(docs.columns)}
    rows = shuffled(docs, columns, key, text, seed, bucket_bytes)
    at_shard, at_slot = _place(shards)
    rows.select(
        *(F.col(f"_w{i}").alias(c) for i, c in enumerate(docs.columns)),
        at_slot.alias(slot), at_shard.alias(shard),
    ).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(
        path, mode="errorifexists", compression="zstd")


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """The records that ``write_shards(docs, path)`` wrote, with their slot and shard."""
    shard, slot = free_names(docs, "shard", "slot")
    schema = T.StructType([*docs.schema.fields, T.StructField(slot, T.LongType()),
                           T.StructField(shard, T.IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path)


def shard_report(docs: DataFrame, path: str, shards: int = 40, key: str = "doc_id",
                 text: str = "text", seed: int = 42, bucket_bytes: int = 8 << 20) -> DataFrame:
    """Write the shards and read them back; the columns of ``assign_shards``, from the files."""
    write_shards(docs, path, shards, key, text, seed, bucket_bytes)
    shard, slot = free_names(docs, "shard", "slot")
    return _report(read_shards(docs, path), key, record_size(text), text_crc32(text),
                   F.col(shard), F.col(slot))
