"""Hard-negative mining by a vertical scan of vector dimensions (BOND).

Anchors are a stated set of rows.  An anchor's positives are its best rows of the same
label; a positive's negatives are the best rows of other labels whose score lies in a
window below the positive's.  Scores are whole-number inner products, so they are exact.

Rows are dealt into blocks and anchors into groups, both of bounded size, and every block
meets every group in a task of its own.  A block is kept by column.  For each anchor the
columns are read in descending order of the anchor's magnitudes; what the rows have still
to come lies between the sums of the least and greatest contributions of the columns not
read, by the block's smallest and largest values.  A bitmap of candidates shrinks by these
bounds: for positives, a row leaves when its upper bound is below the lower bounds of as
many rows as are wanted; for negatives, when its bounds miss every window or when, in the
windows it can reach, enough rows are certain to be better.  What is left after the
last column has exact scores.  Tasks return at most the wanted rows per anchor (or window),
which are ranked once more over all blocks.

Two scans: positives first, since their scores set the windows.  The rows of a block are
sent once per group of anchors and the anchors once per block; nothing is broadcast.

Edge cases: a NULL key, label or vector, and NULL or non-finite components, keep a row out;
an empty vector scores 0, and shorter vectors count as zero in the columns they lack;
components beyond 2**24 after scaling count as 2**24 (with up to 2**15 columns, sums stay
exact); repeated rows are one row, different rows under one key each take part, except
that an anchor is never paired with its own key; an anchor without rows of its label or
with empty windows gives no rows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import quoted, store

LIMIT = 1 << 24
STEP = 8  # columns read between two looks at the bounds


def whole_components(vector: str, scale: int) -> Column:
    """``floor(scale * x)`` of every component, within the limit."""
    return F.transform(quoted_array(vector), lambda x: F.greatest(F.lit(-LIMIT), F.least(
        F.lit(LIMIT), F.floor(x * scale).cast("bigint"))).cast("int"))


def quoted_array(vector: str) -> Column:
    return F.col(quoted(vector)).cast("array<double>")


def taking_part(table: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """``id``, ``label``, ``v``: the rows that can be mined, repeated rows once."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    usable = (F.col(quoted(key)).isNotNull() & label.isNotNull()
              & F.col(quoted(vector)).isNotNull())
    rows = table.where(usable).where(~F.exists(quoted_array(vector), bad))
    return rows.select(
        F.col(quoted(key)).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        whole_components(vector, scale).alias("v")).distinct()


class Block:
    """Some rows by column, sorted by label."""

    def __init__(self, table: pa.Table, width: int):
        labels = table["label"].to_numpy()
        order = np.argsort(labels, kind="stable")
        self.label = labels[order]
        self.id = table["id"].to_numpy()[order]
        self.columns = np.ascontiguousarray(matrix(table["v"], width)[order].T)
        self.least = self.columns.min(axis=1)
        self.most = self.columns.max(axis=1)

    def same_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.label, [label, label + 1]))


def width_of(*tables: pa.Table) -> int:
    return max(1, *(max(t["v"].combine_chunks().value_lengths().to_numpy(), default=0)
                    for t in tables))


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows by columns, zeros where a vector is shorter."""
    arrays = vectors.combine_chunks()
    sizes = arrays.value_lengths().to_numpy()
    out = np.zeros((len(arrays), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = arrays.flatten().to_numpy()
    return out


def scan(block: Block, rows: slice, anchor: np.ndarray, drop: Callable) -> tuple:
    """Positions (in the block) that stay candidates to the end, and their scores.

    ``drop(low, high)`` tells from the bounds of the candidates which stay.
    """
    columns = block.columns[:, rows]
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * block.least, anchor * block.most])[:, order]
    # what the columns from the i-th on can add
    rest = np.zeros((2, len(order) + 1), np.int64)
    rest[:, :-1] = np.stack([ends.min(axis=0), ends.max(axis=0)])[:, ::-1].cumsum(
        axis=1)[:, ::-1]
    candidates = np.arange(columns.shape[1])
    scores = np.zeros(len(candidates), np.int64)
    for at in range(0, len(order), STEP):
        read = order[at:at + STEP]
        part = columns[read]
        if len(candidates) < columns.shape[1]:
            part = part[:, candidates]
        scores += anchor[read] @ part
        low, high = rest[:, min(at + STEP, len(order))]
        stay = drop(scores + low, scores + high)
        if not stay.all():
            candidates, scores = candidates[stay], scores[stay]
            if not len(candidates):
                break
    return candidates + rows.start, scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by smaller id."""
    return np.lexsort((ids, -scores))[:k]


def nth_largest(values: np.ndarray, k: int) -> int | None:
    if len(values) < k:
        return None
    return int(np.partition(values, len(values) - k)[len(values) - k])


def find_positives(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The k best rows of the anchors' own labels in one block."""
    out = {"anchor": [], "other": [], "score": []}
    if left.num_rows and right.num_rows:
        width = width_of(left, right)
        block = Block(left, width)
        for n, a, label, anchor in zip(
                right["anchor"].to_pylist(), right["id"].to_pylist(),
                right["label"].to_pylist(), matrix(right["v"], width)):
            rows = block.same_label(label)
            others = block.id[rows] != a
            # the anchor's own rows can hold back one place each
            room = k + int((~others).sum())

            def drop(low, high, room=room):
                floor = nth_largest(low, room)
                return np.ones(len(high), bool) if floor is None else high >= floor

            at, scores = scan(block, rows, anchor, drop)
            keep = block.id[at] != a
            at, scores = at[keep], scores[keep]
            top = best(scores, block.id[at], k)
            out["anchor"] += [n] * len(top)
            out["other"] += block.id[at[top]].tolist()
            out["score"] += scores[top].tolist()
    return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})


def find_negatives(left: pa.Table, right: pa.Table, k: int, share: tuple[int, int]) -> pa.Table:
    """The k best rows of other labels per window in one block; equal windows once."""
    out = {"anchor": [], "top": [], "other": [], "score": []}
    if left.num_rows and right.num_rows:
        width = width_of(left, right)
        block = Block(left, width)
        everything = slice(0, left.num_rows)
        for n, a, label, tops, anchor in zip(
                right["anchor"].to_pylist(), right["id"].to_pylist(),
                right["label"].to_pylist(), right["tops"].to_pylist(),
                matrix(right["v"], width)):
            # the least whole score with share[0] * top <= share[1] * score
            windows = [(-(-share[0] * t // share[1]), t) for t in tops]
            windows = [w for w in windows if w[0] <= w[1]]
            if not windows:
                continue
            other = block.id != a
            other[block.same_label(label)] = False
            mine = {"other": other}

            def drop(low, high, mine=mine, windows=windows):
                stay, valid = np.zeros(len(low), bool), mine["other"]
                for least, top in windows:
                    # rows certain to lie in this window
                    sure = valid & (low >= least) & (high <= top)
                    floor = nth_largest(low[sure], k)
                    stay |= (high >= (least if floor is None else floor)) & (low <= top)
                stay &= valid
                mine["other"] = valid[stay]
                return stay

            at, scores = scan(block, everything, anchor, drop)
            for least, top in windows:
                inside = np.flatnonzero((scores >= least) & (scores <= top))
                if not len(order := inside[best(scores[inside], block.id[at[inside]], k)]):
                    continue
                out["anchor"] += [n] * len(order)
                out["top"] += [top] * len(order)
                out["other"] += block.id[at[order]].tolist()
                out["score"] += scores[order].tolist()
    return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})


def _dealt(rows: DataFrame, number: int, own: str, meets: int, other: str) -> DataFrame:
    """Rows with their block number, repeated for each of the groups that they meet."""
    return rows.withColumn(
        own, F.pmod(F.xxhash64("id", "label", "v"), F.lit(number)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(meets - 1)))).select(own, other, *rows.columns)


def mine_hard_negatives(table: DataFrame, is_anchor: Column, key: str = "vec_id",
                        vector: str = "embedding", label: Column | None = None,
                        positives: int = 5, negatives: int = 5, scale: int = 256,
                        share: tuple[int, int] = (80, 100), block_rows: int = 32_768,
                        group_rows: int = 8_192, least_blocks: int = 16) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, both scores.

    A negative's score s and its positive's p satisfy ``share[0] * p <= share[1] * s`` and
    ``s <= p``.  ``is_anchor`` is asked of the column ``id`` (the key).  ``block_rows`` and
    ``group_rows`` bound a task; ``least_blocks`` spreads small tables.
    """
    label = F.col("label") if label is None else label
    rows = store(taking_part(table, key, vector, label, scale), "vectors")
    anchors = store(rows.where(is_anchor).withColumn(
        "anchor", F.monotonically_increasing_id()), "anchors")
    n, m = rows.count(), anchors.count()
    blocks = max(-(-n // block_rows), min(least_blocks, -(-n // 512)), 1)
    groups = max(-(-m // group_rows), 1)
    dealt = _dealt(rows, blocks, "block", groups, "group")

    def meet(asked: DataFrame, task: Callable, schema: str) -> DataFrame:
        return dealt.groupBy("block", "group").cogroup(
            _dealt(asked, groups, "group", blocks, "block").groupBy("block", "group")
        ).applyInArrow(task, schema)

    near = meet(anchors, lambda left, right: find_positives(left, right, positives),
                "anchor bigint, other bigint, score bigint")
    order = [F.desc("score"), F.asc("other")]
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    chosen = store(near.withColumn("_at", place).where(F.col("_at") <= positives), "positives")
    asked = anchors.join(
        chosen.groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("tops")), "anchor")
    found = meet(asked, lambda left, right: find_negatives(left, right, negatives, share),
                 "anchor bigint, top bigint, other bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("anchor", "top").orderBy(*order))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= negatives)
    names = anchors.select("anchor", F.col("id").alias("anchor_id"))
    pairs = chosen.join(names, "anchor").select(
        "anchor", "anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("top"))
    return pairs.join(ranked, ["anchor", "top"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), F.col("top").alias("positive_score"),
        F.col("score").alias("negative_score"))
