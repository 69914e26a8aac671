"""Token counts of whole texts: batch encoding in Arrow functions, lengths only.

Each Arrow batch is cut into slices of about ``slice_bytes`` bytes, texts into
segments at boundaries no piece spans (see ``common.segments``), and the
distinct segments of a slice are encoded in one library call that returns
their lengths.  A worker keeps the lengths of recent segments, so common words
are encoded once.  ``cache_entries`` bounds it, which changes speed and memory only.  Nothing is shuffled and no token id leaves a worker.

Edge cases: NULL and empty texts count 0 tokens; very long texts are encoded
segment by segment; other columns pass through unchanged, and output names that
already exist get underscores in front; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import (
    Recent,
    byte_slices,
    free_names,
    front_marks_only,
    segments,
    text_of,
)


class PieceLengths:
    """Token counts of segments for one sentencepiece model."""

    def __init__(self, model_path: str, cache_entries: int):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        # a model with pieces across words is encoded text by text
        self.cut = segments if front_marks_only(pieces) else lambda t: [t] if t else []
        self.known = Recent(lambda s: len(self.model.encode(s)), cache_entries)

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.cut(t) for t in texts]
        known, older = self.known, self.known.older
        new = list({s for parts in cut for s in parts if s not in known and s not in older})
        known.update(zip(new, map(len, self.model.encode(new, num_threads=1))))
        known[""] = 1  # a lone space mark at the end of a text
        out = [sum(map(known.__getitem__, parts)) for parts in cut]
        known.age()
        return out


class JsonLengths:
    """Token counts for a tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def count(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


@functools.lru_cache(maxsize=2)
def lengths_of(model_path: str, cache_entries: int) -> PieceLengths | JsonLengths:
    """One model per worker process, so that later tasks find its cache filled."""
    if model_path.endswith(".model"):
        return PieceLengths(model_path, cache_entries)
    return JsonLengths(model_path)


def token_count(text: Column, model_path: str, slice_bytes: int = 1 << 20,
                cache_entries: int = 500_000) -> Column:
    """The number of tokens of a text column as LONG."""

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = lengths_of(model_path, cache_entries)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.to_pylist()]
            out: list[int] = []
            sizes = pc.fill_null(pc.binary_length(batch), 0).to_pylist()  # UTF-8 bytes
            for a, b in byte_slices(sizes, slice_bytes):
                out += lengths.count(texts[a:b])
            yield pa.array(out, pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, model_path: str, text: str = "text",
                 limit: int = 4096) -> DataFrame:
    """``docs`` plus ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    n_bytes, n_tokens, over = free_names(docs, "n_bytes", "n_tokens", "over_limit")
    counted = docs.withColumns({
        n_bytes: F.octet_length(text_of(text)).cast("bigint"),
        n_tokens: token_count(text_of(text), model_path)})
    return counted.withColumn(over, F.col(n_tokens) > limit)
