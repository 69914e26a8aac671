"""Ordered text lists per key, put together from pieces.

``listagg`` sorts and joins all names of a key in one task.  Here names are dealt by ranges of
key and name, so a key with very many names lies in several tasks, each of which sorts and
joins its own; the pieces of a key, one text each, are then joined in order.  Only the text
that was asked for is ever in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1_000  # copies of a name that are written at once


def list_in_order(counted: DataFrame, keys: Sequence[str], name: str, copies: str, out: str,
                  separator: str = ", ", pieces: int | None = None) -> DataFrame:
    """``keys`` and ``out``: the names of each key in ascending order, each as often as
    ``copies`` says.  NULL names are not listed; a key without names has no row.

    ``pieces`` is the number of ranges; Spark chooses without it.
    """
    keys = list(keys)
    listed = counted.where(F.col(name).isNotNull() & (F.col(copies) > 0)).select(
        *keys, F.col(name).alias("_name"), F.col(copies).cast("bigint").alias("_n"))
    chunks = listed.withColumn("_chunk", F.explode(F.expr(
        f"sequence(0L, (_n - 1) div {CHUNK})"))).withColumn(
        "_times", F.least(F.lit(CHUNK), F.col("_n") - F.col("_chunk") * CHUNK).cast("int"))
    order = [*keys, "_name", "_chunk"]
    dealt = chunks.repartitionByRange(*([pieces] if pieces else []), *map(F.col, order))
    # ranges are numbered in their order
    texts = dealt.withColumns({
        "_piece": F.spark_partition_id(),
        "_text": F.array_join(F.array_repeat("_name", F.col("_times")), separator)})
    local = texts.groupBy(*keys, "_piece").agg(F.array_join(F.transform(F.array_sort(
        F.collect_list(F.struct("_name", "_chunk", "_text"))), lambda x: x["_text"]),
        separator).alias("_text"))
    return local.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(
        F.collect_list(F.struct("_piece", "_text"))), lambda x: x["_text"]),
        separator).alias(out))
