"""Jaccard self-join of documents on their word n-grams by a blocked sparse matrix product.

The documents by n-grams incidence matrix A has a one where a document holds an n-gram, and
the overlap of two documents is an entry of A times its transpose.  Two sets of a and b
n-grams with J = ``num / den`` or more differ in at most ``(a + b) (den - num) / (den +
num)`` n-grams: this bound on the size decides everything below.

Columns (64-bit hashes of n-grams) are dealt into equal hash ranges, the column blocks.  Of
``k + 1 + s`` blocks, a pair within the bound k is equal in at least ``s + 1``, whole blocks
with all their n-grams.  So a document is listed under each block's content, but for its s
smallest blocks: of the equal blocks, the pair's largest is among those that both keep.  A
single frequent n-gram or passage brings no two documents together, only a block equal in
all its n-grams does; empty blocks are listed only for sets so uneven that more than s are
empty.  The number of blocks depends on the class of size; a document near the upper end of
its class is listed in the next, too.

Candidate pairs are entries of the product to be computed: overlaps are added up by column
blocks, and a pair is left as soon as its difference is beyond the bound.  Before its
n-grams are fetched, a pair must pass the bounds on its sizes and on 1,024 parities (each
n-gram flips one bit; bits that differ cannot be more than n-grams that differ).

Groups of near copies would have pairs in the square of their size.  So a list first gives
the pairs of its smallest member with the others, and the components of those that link are
merged.  Then, for up to ``ROUNDS`` turns, a list gives the pairs of one member of its largest
component with one of each other.  Only then are all pairs listed whose ends are in different
components.  No link between components is lost, and links inside one change nothing.  Equal
sets are one row throughout.

Documents are not shuffled: their n-grams are computed twice, once for the blocks, once for
the documents in candidate pairs, told by a bit filter of fixed size (what passes it by
chance is left by a join).

Edge cases: NULL and empty texts have no n-gram, size 0 and link with nothing; fewer words
than ``n`` make one n-gram; repeated rows link by equality and are all kept; rows with a NULL
key get a component, but are never its smallest id; other columns pass through; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.bytewords import Words, mix, sliced
from medallion.llm.common import free_names, quoted, store, text_of
from medallion.llm.simhash import components

FILTER_BITS = 1 << 25
PARITY_BITS = 1024
ROUNDS = 2
COLUMN_BLOCK = 4096  # n-grams of a document whose overlap is added up at once


def ngram_hashes(words: Words, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each row."""
    h = words.hash
    total = h.copy()
    for i in range(1, n):
        # order counts: each further word is mixed into what stands before
        total[:len(h) - i] = mix(total[:len(h) - i] * np.uint64(0x9E3779B97F4A7C15)
                                 + h[i:])
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= n:
            yield np.unique(total[a:b - n + 1])
        elif b > a:
            one = h[a:a + 1]
            for i in range(a + 1, b):
                one = mix(one * np.uint64(0x9E3779B97F4A7C15) + h[i:i + 1])
            yield one
        else:
            yield h[:0]


class Bounds:
    """Bounds that follow from sizes, for Jaccard ``num / den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def difference(self, total: int) -> int:
        """The most n-grams in one of two linked sets only; ``total``: the sum of sizes."""
        return total * (self.den - self.num) // (self.den + self.num)

    def classes(self, size: int) -> list[tuple[int, int]]:
        """(number, largest size) of the classes in which a set of ``size`` can link."""
        low, number = 1, 0
        while (high := max(low, low * 13 // 10)) < size:
            low, number = high + 1, number + 1
        out = [(number, high)]
        if size * self.den // self.num > high:  # a larger partner can be in the next
            out.append((number + 1, max(high + 1, (high + 1) * 13 // 10)))
        return out

    def listed(self, grams: np.ndarray) -> np.ndarray:
        """Hashes of the contents under which the set is listed."""
        out = []
        for number, high in self.classes(len(grams)):
            most = self.difference(2 * high)
            if not most:
                continue  # sets of this class link only when equal
            spare = most // 2 + 2
            blocks = most + 1 + spare
            of = ((grams >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
            first = np.searchsorted(of, np.arange(blocks + 1))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams), dtype=np.uint64)])
            sizes, content = np.diff(first), np.diff(sums[first])
            content = mix(content ^ mix(
                np.arange(blocks, dtype=np.uint64) + np.uint64(number << 40)))
            # the smallest blocks are not listed; the same order in every document
            out.append(content[np.lexsort((content, sizes))[spare:]])
        return np.concatenate(out) if out else grams[:0]

    def overlap(self, a: np.ndarray, b: np.ndarray) -> int:
        """Common n-grams of two sorted sets, or -1 once they differ too much."""
        most, common, at = self.difference(len(a) + len(b)), 0, 0
        for start in range(0, len(a), COLUMN_BLOCK):
            block = a[start:start + COLUMN_BLOCK]
            last = start + COLUMN_BLOCK >= len(a)
            end = len(b) if last else int(np.searchsorted(b, block[-1], "right"))
            other = b[at:end]
            place = np.searchsorted(other, block)
            place[place == len(other)] = 0
            hits = int((other[place] == block).sum()) if len(other) else 0
            common, at = common + hits, end
            # of what was read, all but the common n-grams are in one set only
            if start + len(block) + end - 2 * common > most:
                return -1
        return common

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        common = self.overlap(a, b)
        return common >= 0 and self.den * common >= self.num * (len(a) + len(b) - common)


_PARITIES = [f"p{i}" for i in range(PARITY_BITS // 64)]


def _parities(grams: np.ndarray) -> np.ndarray:
    odd = np.bincount((grams & np.uint64(PARITY_BITS - 1)).astype(np.int64),
                      minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _name(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    if not len(grams):
        return 0, 0
    with np.errstate(over="ignore"):
        a, b = grams.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(grams + np.uint64(7)))
        both = mix(np.array([a, b + np.uint64(len(grams))], np.uint64))
    return tuple(int(x) for x in both.view(np.int64))


_SET = ("struct<n:bigint,hi:bigint,lo:bigint,"
        + "".join(f"{p}:bigint," for p in _PARITIES) + "blocks:array<bigint>>")


def _sets(text, n: int, bounds: Bounds):
    @F.arrow_udf(_SET)
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes, names, parities, listed = [], [], [], []
            for _, _, words in sliced(batch):
                for grams in ngram_hashes(words, n):
                    sizes.append(len(grams))
                    names.append(_name(grams))
                    parities.append(_parities(grams))
                    listed.append(bounds.listed(grams).view(np.int64))
            names = np.array(names, np.int64).reshape(-1, 2)
            parities = np.array(parities, np.int64).reshape(-1, len(_PARITIES))
            ends = np.cumsum([0, *map(len, listed)])
            flat = np.concatenate(listed) if listed else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), *map(pa.array, names.T), *map(pa.array, parities.T),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["n", "hi", "lo", *_PARITIES, "blocks"])

    return describe(text)


def _filter_of(names: DataFrame) -> np.ndarray:
    """Bits at four places per name (``hi``, ``lo``), of fixed size whatever their number."""
    places = F.array(*(F.pmod(F.col(c), F.lit(FILTER_BITS)) for c in (
        "hi", "lo")), *(F.pmod(F.shiftright(c, 32), F.lit(FILTER_BITS)) for c in ("hi", "lo")))
    words = names.select(F.explode(places).alias("b")).select(
        F.shiftright("b", 6).alias("w"), F.col("b").bitwiseAND(F.lit(63)).cast("int").alias("s"))
    found = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, s)")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[found["w"].to_numpy()] = found["bits"].to_numpy()
    return out


def _passes(bits: np.ndarray, hi: int, lo: int) -> bool:
    places = [hi % FILTER_BITS, lo % FILTER_BITS,
              (hi >> 32) % FILTER_BITS, (lo >> 32) % FILTER_BITS]
    return all(int(bits[p >> 6]) >> (p & 63) & 1 for p in places)


def _fetched(docs: DataFrame, text: str, n: int, names: DataFrame) -> DataFrame:
    """``hi``, ``lo``, ``grams`` (packed hashes) of the named sets, each once."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter_of(names))

    @F.arrow_udf("struct<hi:bigint,lo:bigint,grams:binary>")
    def fetch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for _, _, words in sliced(batch):
                for grams in ngram_hashes(words, n):
                    hi, lo = _name(grams)
                    rows.append({"hi": hi, "lo": lo, "grams": grams.tobytes()}
                                if len(grams) and _passes(bits.value, hi, lo) else None)
            yield pa.array(rows, pa.struct(
                [("hi", pa.int64()), ("lo", pa.int64()), ("grams", pa.binary())]))

    found = docs.select(fetch(text_of(text)).alias("_s")).where("_s is not null").select("_s.*")
    # copies are left in their task, before anything is shuffled
    once = found.groupBy("hi", "lo").agg(F.first("grams").alias("grams"))
    return once.join(names, ["hi", "lo"], "left_semi")


def _checked(pairs: DataFrame, grams: DataFrame, bounds: Bounds) -> DataFrame:
    """The pairs ``a``, ``b`` of set ids that link, by their entries of the product."""
    @F.arrow_udf("boolean")
    def link(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([bounds.linked(np.frombuffer(x.as_buffer(), np.uint64),
                                       np.frombuffer(y.as_buffer(), np.uint64))
                         for x, y in zip(left, right)], pa.bool_())

    left = grams.select(F.col("set").alias("a"), F.col("grams").alias("_a"))
    right = grams.select(F.col("set").alias("b"), F.col("grams").alias("_b"))
    return pairs.join(left, "a").join(right, "b").where(link("_a", "_b")).select("a", "b")


def _possible(left: str, right: str, num: int, den: int) -> Column:
    """Whether sizes and parities (columns with these suffixes) allow a link."""
    flips = sum((F.bit_count(F.col(p + left).bitwiseXOR(F.col(p + right)))
                 for p in _PARITIES), F.lit(0))
    a, b = F.col("n" + left), F.col("n" + right)
    return ((a * den >= b * num) & (b * den >= a * num)
            & (flips * (den + num) <= (a + b) * (den - num)))


def _described(pairs: DataFrame, sets: DataFrame, ends: str) -> DataFrame:
    """Pairs of set ids with the sizes and parities of both."""
    for end in ends:
        pairs = pairs.join(sets.select(F.col("set").alias(end), *(
            F.col(c).alias(f"{c}_{end}") for c in ("n", *_PARITIES))), end)
    return pairs


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``set`` and ``root`` after the components of linked sets are joined."""
    ends = (labels.select(F.col("set").alias(e), F.col("root").alias(f"_{e}")) for e in "ab")
    for end in ends:
        links = links.join(end, end.columns[0])
    tops = components(links.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
    return store(labels.join(tops.select(F.col("node").alias("root"), F.col("root").alias("_t")),
                             "root", "left").select("set", F.coalesce("_t", "root").alias("root")),
                 "components")


def _mixed(listed: DataFrame, labels: DataFrame) -> DataFrame:
    """``block``, ``set``, ``root`` of the lists that hold several components."""
    placed = listed.select("block", "set").join(labels, "set")
    mixed = placed.groupBy("block").agg(F.min("root").alias("_r"), F.max("root").alias("_s"))
    return placed.join(mixed.where("_r < _s").select("block"), "block")


def _hub_pairs(placed: DataFrame, turn: int) -> DataFrame:
    """Per list one member of its largest component, with one of each other component; the
    members are drawn by list, so a set meets another member in each of its lists."""
    drawn = F.xxhash64(F.lit(turn), "block", "set")
    parts = placed.groupBy("block", "root").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(drawn.alias("h"), "set")).alias("_m"))
    hubs = parts.groupBy("block").agg(F.max(F.struct("_n", "root", "_m.set")).alias("_hub"))
    return parts.join(hubs, "block").where(F.col("root") != F.col("_hub.root")).select(
        F.least("_m.set", "_hub.set").alias("a"),
        F.greatest("_m.set", "_hub.set").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 3,
                    num: int = 9, den: int = 10, carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (default: all) plus ``n_shingles`` and ``component_id``.

    Documents link when ``den`` times their common n-grams are at least ``num`` times all.
    """
    carry = docs.columns if carry is None else carry
    kept = [f"_c{i}" for i in range(len(carry))]
    bounds = Bounds(num, den)
    marks = store(docs.select(
        *(F.col(quoted(c)).alias(k) for c, k in zip(carry, kept)),
        F.col(quoted(key)).alias("_key"), _sets(text_of(text), n, bounds).alias("_s")),
        "ngram-sets")
    sets = store(marks.where("_s.n > 0").select("_key", "_s.*").groupBy("hi", "lo").agg(
        F.min("_key").alias("least"), F.first(F.struct(
            "n", *_PARITIES, "blocks")).alias("_f")).select(
        F.monotonically_increasing_id().alias("set"), "hi", "lo", "least", "_f.*"), "sets")

    # a list of one gives no pair; others get the smallest member as their centre
    entries = sets.select("set", F.explode("blocks").alias("block"))
    shared = entries.groupBy("block").agg(
        F.min("set").alias("centre"), F.max("set").alias("_last")).where("centre < _last")
    listed = store(entries.join(shared.select("block", "centre"), "block"), "block-lists")
    stars = listed.where("set <> centre").select(
        F.col("centre").alias("a"), F.col("set").alias("b")).distinct()
    stars = _described(stars, sets, "ab").where(_possible("_a", "_b", num, den)).select("a", "b")

    names = store(listed.select("set").distinct().join(sets.select("set", "hi", "lo"), "set"),
                  "listed-sets")
    grams = store(_fetched(docs, text, n, names.select("hi", "lo")).join(
        names, ["hi", "lo"]).select("set", "grams"), "candidate-ngrams")
    labels = names.select("set", F.col("set").alias("root"))
    labels = _merged(labels, _checked(stars, grams, bounds))
    for turn in range(ROUNDS):
        hubs = _hub_pairs(_mixed(listed, labels), turn)
        hubs = _described(hubs, sets, "ab").where(_possible("_a", "_b", num, den))
        found = store(_checked(hubs.select("a", "b"), grams, bounds), "hub-links")
        if found.isEmpty():
            break
        labels = _merged(labels, found)

    # what is left: sizes and parities are compared in the join, which makes no pair that
    # they rule out
    placed = _mixed(listed, labels).join(sets.select("set", "n", *_PARITIES), "set")
    left, right = (placed.select("block", *(
        F.col(c).alias(f"{c}_{end}") for c in ("set", "root", "n", *_PARITIES))) for end in "ab")
    across = left.join(right, [
        left["block"] == right["block"], F.col("set_a") < F.col("set_b"),
        F.col("root_a") != F.col("root_b"), _possible("_a", "_b", num, den)]).select(
        F.col("set_a").alias("a"), F.col("set_b").alias("b")).distinct()
    labels = _merged(labels, _checked(across, grams, bounds))

    classes = sets.select("set", "hi", "lo", "least").join(labels, "set", "left").withColumn(
        "root", F.coalesce("root", "set"))
    ids = classes.groupBy("root").agg(F.min("least").alias("_id"))
    classes = classes.join(ids, "root").select("hi", "lo", "_id")

    names_out = free_names(docs.select(*(F.col(quoted(c)) for c in carry)),
                           "n_shingles", "component_id")
    flat = marks.select(*kept, "_key", F.col("_s.n").alias("_n"), F.col("_s.hi").alias("hi"),
                        F.col("_s.lo").alias("lo"))
    # a document without n-grams is its own component
    return flat.join(classes, ["hi", "lo"], "left").select(
        *(F.col(k).alias(c) for k, c in zip(kept, carry)),
        F.col("_n").alias(names_out[0]),
        F.when(F.col("_n") > 0, F.col("_id")).otherwise(F.col("_key")).alias(names_out[1]))
