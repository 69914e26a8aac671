"""Filter interaction audit by the Hart and Mas-Colell potential of the removal game.

Each filter is a player and the worth v(S) of a coalition is the number of documents that
at least one filter of S removes.  The potential is recursive: P({}) = 0 and
``P(S) = (v(S) + sum of P(S without i) over i in S) / |S|``; a filter's Shapley value is
``P(N) - P(N without i)``.  What a filter removes at its step of an order is the difference
of two coalitions: those before it with it, and without it.

Documents are counted per part and set of failing filters, one short row per combination,
so the game is played on 2**filters numbers per part, not on documents.  All values are
whole numbers: the potential is kept times the factorial of the number of filters, which
is the sum of what the filter removes over all orders.

The duplicate filter needs the smallest key of each text.  Texts meet as 256-bit digests:
the smallest key of a digest is a pre-aggregated minimum, and the rows that hold it are
found by joining on digest and key together, so that no copied text fills a task.

Edge cases: a NULL or empty text has no words (it fails filters on few words only); a NULL
part is the part ''; rows without a key are copies of nothing, and no row is a copy of them;
repeated rows of one key and text are not copies of each other; a key that stands in
several label rows is good when one of them says so; labels of unknown keys count for
nothing; extra columns are ignored; an empty table has no parts and gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import ASCII_SPACE, quoted, store, text_of


def text_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions A to D, each of a row's text alone."""
    body = text_of(text)
    words = F.array_remove(F.split(body, ASCII_SPACE, -1), "")
    capitals = F.octet_length(body) - F.octet_length(F.regexp_replace(body, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)).cast("bigint") * 100 < F.size(words) * F.lit(65),
        "C": capitals.cast("bigint") * 100 > F.length(body).cast("bigint") * 5,
        "D": body.rlike(r"[#$%&*|]"),
    }


def _bits(conditions: list[Column]) -> Column:
    """The failing filters as a number: bit i stands for the i-th."""
    return reduce(lambda a, b: a + b, (
        F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)))


def failures(docs: DataFrame, filters: dict[str, Column], duplicates: str | None,
             part: Column, key: str, text: str) -> DataFrame:
    """``part``, ``id``, ``mask`` of failing filters and ``n`` rows, for each row or several
    equal ones.  ``duplicates`` names the filter, after ``filters``, that copies fail."""
    rows = docs.select(
        part.alias("part"), F.col(quoted(key)).alias("id"),
        _bits(list(filters.values())).alias("mask"),
        F.unhex(F.sha2(text_of(text).cast("binary"), 256)).alias("digest"))
    rows = store(rows.groupBy("part", "id", "mask", "digest").agg(
        F.count(F.lit(1)).alias("n")), "filter-failures")
    if duplicates is None:
        return rows.drop("digest")
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).where(
        "id is not null").withColumn("_first", F.lit(True))
    copy = F.col("_first").isNull() & F.col("id").isNotNull()
    return rows.join(first, ["digest", "id"], "left").select(
        "part", "id", (F.col("mask") + F.when(copy, 1 << len(filters)).otherwise(0))
        .alias("mask"), "n")


def _worth(counts: Column, players: int) -> Column:
    """v(S) for every coalition S, from the documents per set of failing filters."""
    def removed(s: Column) -> Column:
        hit = F.transform(counts, lambda n, m: F.when(m.bitwiseAND(s) != 0, n).otherwise(0))
        return F.aggregate(hit, F.lit(0).cast("bigint"), lambda a, n: a + n)

    return F.transform(F.sequence(F.lit(0), F.lit((1 << players) - 1)), removed)


def _potential(worth: Column, players: int) -> Column:
    """Potentials of all coalitions times ``players!``; subsets have smaller numbers."""
    whole = math.factorial(players)

    def next_one(done: Column, s: Column) -> Column:
        less = [F.when(s.bitwiseAND(F.lit(1 << i)) != 0,
                       F.get(done, s.bitwiseXOR(F.lit(1 << i)))).otherwise(F.lit(0))
                for i in range(players)]
        total = F.get(worth, s) * whole + reduce(lambda a, b: a + b, less)
        # the sum is a multiple of the coalition's size
        return F.concat(done, F.array(F.call_function("div", total, F.bit_count(s))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << players) - 1)),
                       F.array(F.lit(0).cast("bigint")), next_one)


def _orders(parts: DataFrame, names: list[str]) -> DataFrame:
    """Every part with each order of the filters, as text ``filter_order``."""
    out = parts.withColumns({"filter_order": F.lit(""), "_left": F.array(*map(F.lit, names))})
    for _ in names:
        out = out.withColumn("_next", F.explode("_left")).withColumns({
            "filter_order": F.concat("filter_order", "_next"),
            "_left": F.array_remove("_left", F.col("_next"))}).drop("_next")
    return out.drop("_left")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None,
          duplicates: str | None = "E", part: str = "source", key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """One row per part, order of the filters and step, with what the step removes.

    ``filters`` are failure conditions under one-letter names (default: A to D of
    ``text_filters``); ``duplicates`` names the filter of copies, None for none.
    """
    filters = text_filters(text) if filters is None else filters
    names = [*filters, *([duplicates] if duplicates else [])]
    players, everyone = len(names), (1 << len(names)) - 1
    part_of = F.coalesce(F.col(quoted(part)).cast("string"), F.lit(""))
    failing = failures(docs, filters, duplicates, part_of, key, text)
    marks = labels.select(
        F.col(quoted(key)).alias("id"), (F.col("quality") == 1).alias("good"),
        (F.col("toxic") == 1).alias("toxic")).groupBy("id").agg(
        F.coalesce(F.max("good"), F.lit(False)).alias("good"),
        F.coalesce(F.max("toxic"), F.lit(False)).alias("toxic"))
    marked = failing.join(marks.where("good or toxic"), "id", "left")
    cells = marked.groupBy("part", "mask").agg(
        F.sum("n").alias("all"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))
    games = ("all", "good", "toxic")
    counts = cells.groupBy("part").agg(*(
        F.array(*(F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(g))), F.lit(0))
                  for m in range(everyone + 1))).alias(g) for g in games))
    worth = counts.select(
        "part", F.aggregate("all", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        *(_worth(F.col(g), players).alias(g) for g in games))
    # stored: one row per part, else each of its many readers below would play the game anew
    played = store(worth.withColumn("potential", _potential(F.col("all"), players)), "games")
    steps = _orders(played, names).select(
        "*", F.posexplode(F.split("filter_order", "")).alias("_at", "_letter"))
    bit = reduce(lambda a, b: a + b, (
        F.when(F.col("_letter") == c, 1 << i).otherwise(0) for i, c in enumerate(names)))
    before = F.aggregate(
        F.split(F.substring("filter_order", F.lit(1), F.col("_at")), ""), F.lit(0),
        lambda a, x: a + reduce(lambda p, q: p + q, (
            F.when(x == c, 1 << i).otherwise(0) for i, c in enumerate(names))))
    steps = steps.withColumns({"_bit": bit, "_before": before})
    after = F.col("_before") + F.col("_bit")

    def gained(game: str) -> Column:
        return F.get(F.col(game), after) - F.get(F.col(game), F.col("_before"))

    without = F.lit(everyone) - F.col("_bit")
    return steps.select(
        "part", "filter_order", (F.col("_at") + 1).cast("int").alias("step"),
        (F.col("total") - F.get("all", after)).alias("kept"),
        gained("all").alias("removed"),
        (F.get("all", F.col("_bit")) - gained("all")).alias("redundant"),
        (F.get("all", F.lit(everyone)) - F.get("all", without)).alias("unique_fails"),
        gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(everyone)) - F.get("potential", without)).alias("shapley"))
