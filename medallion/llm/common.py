"""Helpers shared by the operators: column names, stored results, text batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.session import SHUFFLE_CLEANUP as _CLEANUP  # noqa: F401
from medallion.session import scratch_dir, shuffles_freed

# Words of the corpus operators: runs of anything but ASCII white space.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each with underscores in front until unused in ``df``."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_of(column: str) -> Column:
    """The text, NULL counting as empty."""
    return F.coalesce(F.col(quoted(column)).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, upper, upper.lower())


def crc_remainder(key: str, modulus: int) -> Column:
    """``crc32`` of the key written as text, modulo ``modulus``; a NULL key as ''."""
    as_text = F.coalesce(F.col(quoted(key)).cast("string"), F.lit(""))
    return F.pmod(F.crc32(as_text.cast("binary")), F.lit(modulus))


def store(df: DataFrame, purpose: str, free: bool = False) -> DataFrame:
    """Write to the cluster's shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read of the files.  ``free`` has Spark
    remove this write's shuffle files when it is done, not when the driver next collects
    garbage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    with shuffles_freed(spark) if free else nullcontext():
        df.write.parquet(path, mode="overwrite", compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def byte_slices(lengths, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; one longer row stands alone."""
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)


# --- pieces of a text that a piece tokenizer encodes independently ------------------

_CUT = re.compile("(?<=[^ ▁])[ ▁]")
MARK = "▁"


def segments(text: str) -> list[str]:
    """Cut a text where no piece can span: between a word and the space after it.

    Holds for vocabularies whose pieces carry the space mark (U+2581) only at
    their front, which ``front_marks_only`` checks.  The space at a cut is
    dropped, since encoding a segment puts a mark in front again.  Only the last
    segment can be empty: a lone space mark.
    """
    if not text:
        return []
    odd = "  " in text or MARK in text or text[0] == " " or text[-1] == " "
    return _CUT.split(text) if odd else text.split(" ")


def front_marks_only(pieces) -> bool:
    return not any("▁" in p.lstrip("▁") for p in pieces)


class Recent(dict):
    """A cache of bounded size that keeps what is used often.

    ``cache[key]`` computes what is missing.  ``age`` drops, beyond half the limit,
    what has not been used since the last time it did so.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.half, self.older = compute, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def age(self) -> None:
        if len(self) > self.half:
            self.older = dict(self)
            self.clear()
