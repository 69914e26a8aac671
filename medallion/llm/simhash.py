"""SimHash near-duplicates by anchor-point covering.

Fingerprint: lower-case A-Z, words, ``shingle``-word shingles with repeats; bit i is 1
when it is set in over half of the shingles' XXH64 (seed 42).

Search: two fingerprints within ``2`` bits differ by at most one bit in one of their two
32-bit halves.  Per half the anchors are a covering code: the perfect Hamming code on
its lower 31 bits, the top bit free, which has 2**27 anchors and covering radius 1.  A
fingerprint's home is its nearest anchor; it is replicated to every anchor within
the radius plus the threshold (1 + 1 = 2), at most 17 per half.  If x and y differ by
one bit in a half, y has a replica at x's home, so comparing homes with replicas per
anchor finds every pair.  Differences are checked on all 64 bits.

Scale: equal fingerprints are one row before the search, so a group of copies
costs nothing, and a fingerprint has at most 64 + 2016 others within 2 bits,
which bounds the links per row.  Anchors are spread by hash; adaptive execution
splits those that many fingerprints share.  Components are found by alternating
star contractions over the links, each round written to the shared folder.

Edge cases: NULL and empty texts have fingerprint zero and link like any other; fewer
words than a shingle make one shingle; rows with a NULL key get a component but are
never its smallest id; repeated rows are kept; other columns pass through; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import free_names, quoted, store, text_of

# parity masks of the Hamming code on bits 0..30: bit p belongs to check j when p + 1 has bit j
_CHECKS = [sum(1 << p for p in range(31) if (p + 1) >> j & 1) for j in range(5)]


def simhash_bits(text: str, shingle: int) -> int:
    """The fingerprint of one text as a signed 64-bit integer."""
    import xxhash

    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, 42)], ">u8")
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        cut = map(slice, (ends - sizes)[:len(words) - shingle + 1].tolist(),
                  (ends - 1)[shingle - 1:].tolist())
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, map(line.__getitem__, cut), repeat(42)), ">u8")
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[part:part + (1 << 16)].view(np.uint8))
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprints(text: Column, shingle: int = 3) -> Column:
    @F.arrow_udf("bigint")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([simhash_bits(t or "", shingle) for t in batch.to_pylist()],
                           pa.int64())

    return simhash(text)


def fingerprint_hex(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def _halves(prints: DataFrame) -> DataFrame:
    """Two rows per fingerprint: half number, the half's 32 bits, its syndrome."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    rows = prints.select("fp", F.posexplode(F.array(low, high)).alias("half", "bits"))
    syndrome = F.lit(0)
    for j, mask in enumerate(_CHECKS):
        parity = F.bit_count(F.col("bits").bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1))
        syndrome = syndrome + parity * (1 << j)
    return rows.withColumn("s", syndrome.cast("int"))


# the nearest code word, and all at distance 2 from the bits when that is at distance 1
_HOME = "if(s = 0, bits, bits ^ shiftleft(1L, s - 1))"
_FAR = ("transform(filter(sequence(1, 31), i -> s > 0 and i < (i ^ s)), "
        "i -> bits ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ s) - 1))")
_TOP = 1 << 31


def links(prints: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints that differ by 1 or 2 bits."""
    halves = _halves(prints)
    home = F.expr(_HOME)
    homes = halves.select("half", home.alias("anchor"), F.col("fp").alias("a"))
    replicas = halves.select("half", F.explode(F.concat(
        F.array(home, home.bitwiseXOR(F.lit(_TOP))), F.expr(_FAR))).alias("anchor"),
        F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    found = homes.join(replicas, (homes["half"] == replicas["half"])
                       & (homes["anchor"] == replicas["anchor"]) & (F.col("a") != F.col("b"))
                       & near)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of an edge.

    Large-star and small-star steps in turn: neighbours hang themselves to the smallest
    node they know until nothing changes, in a logarithmic number of rounds.
    """
    # larger end first, as all later rounds have it: links that are a forest of stars already
    # are settled as they stand
    edges = store(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")),
                  "links")
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # every larger neighbour hangs itself to the smallest one
        large = both.join(least, "u").where("v > u").select("v", F.col("m").alias("w"))
        large = large.select(F.col("v").alias("u"), F.col("w").alias("v")).where(
            "u <> v").distinct()
        large = store(large, "large-star")
        down = large.where("v < u")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(
            F.explode(F.array("u", "v")).alias("x"), F.col("m").alias("y")).where("x <> y")
        new = store(small.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
                    .distinct(), "small-star")
        if _same(edges, new):
            break
        edges = new
    else:
        raise RuntimeError(f"links are not settled after {rounds} rounds")
    tree = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return tree.unionByName(tree.select(F.col("root").alias("node"), "root").distinct())


def _same(old: DataFrame, new: DataFrame) -> bool:
    """Equal edge sets, judged by their size and hash sums."""
    def mark(edges: DataFrame):
        h = F.xxhash64(F.greatest("u", "v"), F.least("u", "v"))
        return edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.bit_xor(F.xxhash64(h))).first()

    return mark(old) == mark(new)


def _marks(docs: DataFrame, key: str, text: str, shingle: int, carry: list[str]) -> DataFrame:
    """The ``carry`` columns as ``_c0``.., ``_key``, ``_fp``, and ``_row``, another number in
    each row.  Stored once, so texts are hashed once and the numbers stay."""
    return store(docs.select(
        *(F.col(quoted(c)).alias(f"_c{i}") for i, c in enumerate(carry)),
        F.col(quoted(key)).alias("_key"),
        fingerprints(text_of(text), shingle).alias("_fp"),
        F.monotonically_increasing_id().alias("_row")), "fingerprints")


def _rooted(prints: DataFrame, edges: DataFrame) -> DataFrame:
    """``prints`` plus ``root``, the smallest fingerprint of the component."""
    roots = components(edges).withColumnRenamed("root", "_root")
    return prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        *prints.columns, F.coalesce("_root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = 3, carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (default: all) plus ``fingerprint`` (hex), ``component_id``
    and ``n_links``, the number of other fingerprints within 2 bits.
    """
    carry = docs.columns if carry is None else carry
    kept = [f"_c{i}" for i in range(len(carry))]
    marks = _marks(docs, key, text, shingle, carry)
    prints = marks.groupBy(F.col("_fp").alias("fp")).agg(F.min("_key").alias("_least"))
    edges = store(links(prints.select("fp")), "fingerprint-links")
    degree = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count()
    classes = _rooted(prints, edges)
    ids = classes.groupBy("root").agg(F.min("_least").alias("_id"))
    classes = classes.join(ids, "root").join(
        degree, F.col("fp") == F.col("node"), "left").select(
        "fp", "_id", F.coalesce("count", F.lit(0)).cast("bigint").alias("_links"))
    names = free_names(marks.select(*(F.col(k).alias(c) for c, k in zip(carry, kept))),
                       "fingerprint", "component_id", "n_links")
    return marks.join(classes, F.col("_fp") == F.col("fp")).select(
        *(F.col(k).alias(c) for c, k in zip(carry, kept)),
        fingerprint_hex(F.col("_fp")).alias(names[0]), F.col("_id").alias(names[1]),
        F.col("_links").alias(names[2]))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                         shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest key; columns unchanged.

    NULL keys come last; rows of one key are told apart by fingerprint, then by a hash of the
    row.  The choice is a minimum per fingerprint, then per component's root: a key that
    stands in several components leaves a row in each.
    """
    marks = _marks(docs, key, text, shingle, docs.columns)
    plain = [f"_c{i}" for i, (_, kind) in enumerate(docs.dtypes) if "map<" not in kind]
    best = marks.groupBy(F.col("_fp").alias("fp")).agg(F.min(F.struct(
        F.col("_key").isNull(), "_key", fingerprint_hex(F.col("_fp")),
        F.xxhash64(*plain), "_row")).alias("_best"))
    best = store(best, "least-rows")
    edges = store(links(best.select("fp")), "fingerprint-links")
    chosen = _rooted(best, edges).groupBy("root").agg(F.min("_best").alias("_best"))
    rows = chosen.select(F.col("_best._row").alias("_chosen"))
    return marks.join(rows, F.col("_row") == F.col("_chosen"), "left_semi").select(
        *(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)))
