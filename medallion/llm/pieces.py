"""Piece encoding and decoding by a table of each prefix's last token.

For a merge-type vocabulary every prefix of a text has exactly one last token.
It is found left to right: an automaton lists the tokens ending at a
position; the right one stands at the start of the text or is compatible with
the last token of the prefix before it, that is, encoding the two strings together
gives just these two tokens.  The ids are recovered backwards from the end.  The
table depends on the prefix alone, so strings are taken in order and each starts
with the part of the table that it shares with the one before.

A string for which none fits (a vocabulary with odd merges) is merged pair by
pair instead, which is the definition.  Segments are the parts of a text between
places no piece spans; their ids are kept in a cache of bounded size, so the
table is filled once for a word that occurs often.  Texts are taken in slices of about
``SLICE_BYTES``, whose segments that are not in the cache are encoded first.

Characters outside the vocabulary become their UTF-8 byte tokens.  Decoding
joins the pieces, turns byte tokens back into UTF-8, space marks into spaces and
drops the space that encoding put in front.

Edge cases: NULL and empty texts give no ids besides begin and end; other
columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
import struct
from collections.abc import Iterator
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import (
    Recent,
    byte_slices,
    free_names,
    front_marks_only,
    segments,
    text_of,
)

MARK = "▁"
DIGEST = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"
ENCODED = "struct<ids:array<int>,decoded:string>"
SLICE_BYTES = 4 << 20


class PrefixTable:
    """One vocabulary: pieces, scores, automaton and remembered pair tests."""

    def __init__(self, model_path: str, cache_entries: int = 800_000):
        import ahocorasick
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = lib.get_piece_size()
        self.bos, self.eos, self.unk = lib.bos_id(), lib.eos_id(), lib.unk_id()
        self.piece = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_control(i) or lib.is_unknown(i) for i in range(size)]
        is_byte = [lib.is_byte(i) for i in range(size)]
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in range(size) if is_byte[i]}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        plain = [i for i in range(size) if not special[i] and not is_byte[i]]
        self.id = {self.piece[i]: i for i in plain}
        self.score = {self.piece[i]: lib.get_score(i) for i in plain}
        if not front_marks_only(self.id):
            raise ValueError("pieces across words are not supported")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.packed = [struct.pack("<I", i) for i in range(size)]
        self.odd = frozenset([*self.byte_of, self.unk])
        self.before, self.table = "", [-1]
        self.inside = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        self.shown = [p.replace(MARK, " ") for p in self.piece]
        self.pairs: dict[int, bool] = {}
        self.edges: dict[str, tuple[list, list] | None] = {}
        self.known = Recent(lambda s: self._whole(self.cut(s)), cache_entries)
        self.parts = Recent(self._coded, cache_entries)
        self.pair_limit = 1_000_000

    def merge(self, symbols: str) -> list[str]:
        """The definition: merge the best-scored adjacent pair, leftmost first."""
        return self._merge(symbols)[0]

    def _merge(self, symbols: str) -> tuple[list[str], tuple[str, str] | None]:
        """The merged parts, and the two parts that the latest merge joined."""
        parts, joined = list(symbols), None
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            joined = parts[at], parts[at + 1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts, joined

    def _edges(self, piece: str) -> tuple[list, list] | None:
        """The symbols that stand at the left and at the right edge while ``piece`` is
        merged, each with the ranks at which it appears and is merged further.  None
        if the piece does not come about by merging."""
        if piece in self.edges:
            return self.edges[piece]
        if len(piece) == 1:
            born, sides = -math.inf, ([], [])
        else:
            parts, joined = self._merge(piece)
            if parts != [piece]:
                self.edges[piece] = None
                return None
            born = -self.score[piece]
            sides = tuple(
                [(s, b, min(e, born)) for s, b, e in self._edges(joined[k])[k]] for k in (0, 1))
        found = self.edges[piece] = tuple([(piece, born, math.inf), *side] for side in sides)
        return found

    def _compatible(self, left_id: int, right_id: int) -> bool:
        """Whether encoding the two strings together gives the two: no merge crosses."""
        left, right = self.piece[left_id], self.piece[right_id]
        if self._edges(right) is None:
            return False
        found = True
        for a, a_from, a_to in self._edges(left)[1]:
            for b, b_from, b_to in self._edges(right)[0]:
                score = self.score.get(a + b)
                if score is None:
                    continue
                first, end = max(a_from, b_from), min(a_to, b_to)
                if max(first, -score) == end:  # equal ranks: position decides
                    found = self.merge(left + right) == [left, right]
                    break
                if max(first, -score) < end:
                    found = False
                    break
            else:
                continue
            break
        return found

    def tokens(self, marked: str) -> list[int]:
        """Ids of a string of characters that are pieces."""
        n, pairs, piece = len(marked), self.pairs, self.piece
        shared = 0
        for a, b in zip(self.before, marked):
            if a != b:
                break
            shared += 1
        last = self.table[:shared + 1] + [-1] * (n - shared)
        # several tokens may end at a position; exactly one fits, so the first that
        # does ends the search
        done = shared - 1
        for end, (token, size) in self.automaton.iter(marked):
            if end <= done:
                continue
            start = end + 1 - size
            if start:
                key = last[start] << 24 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self._compatible(last[start], token)
            else:
                fits = self._edges(piece[token]) is not None
            if fits:
                last[end + 1] = token
                done = end
        self.before, self.table = marked, last
        if len(pairs) > self.pair_limit:
            pairs.clear()
        out = []
        while n:
            if last[n] < 0:  # a vocabulary with odd merges
                return [self.id[p] for p in self.merge(marked)]
            out.append(last[n])
            n -= len(piece[last[n]])
        return out[::-1]

    def _part(self, part: str) -> tuple[int, ...]:
        """Ids of a string that no cut divides."""
        if len(part) > 1:
            return tuple(self.tokens(part))
        if part in self.id:
            return (self.id[part],)
        return tuple(self.byte_id[b] for b in part.encode()) if self.byte_id else (self.unk,)

    def cut(self, segment: str) -> list[str]:
        """A segment, cut again where two characters stand in no piece together."""
        marked, inside = MARK + segment.replace(" ", MARK), self.inside
        if inside.issuperset(map(add, marked, marked[1:])):
            return [marked]
        cuts = [i for i in range(1, len(marked)) if marked[i - 1:i + 1] not in inside]
        return [marked[a:b] for a, b in zip([0, *cuts], [*cuts, len(marked)])]

    def text(self, ids: tuple[int, ...]) -> str:
        """Pieces of one segment as text, its front space included."""
        if self.odd.isdisjoint(ids):
            return "".join(map(self.shown.__getitem__, ids))
        raw = b"".join(
            bytes((self.byte_of[i],)) if i in self.byte_of else
            " ⁇ ".encode() if i == self.unk else self.shown[i].encode() for i in ids)
        return raw.decode(errors="replace")

    def _coded(self, part: str) -> tuple[bytes, str]:
        ids = self._part(part)
        return b"".join([self.packed[i] for i in ids]), self.text(ids)

    def _whole(self, parts: list[str]) -> tuple[bytes, str]:
        """A segment from its parts, none of which ends inside a character."""
        if len(parts) == 1:
            return self.parts[parts[0]]
        found = [self.parts[p] for p in parts]
        return b"".join([p[0] for p in found]), "".join([p[1] for p in found])

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, begin and end included; the decoded text."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """``encode`` of each text."""
        known, parts = self.known, self.parts
        begin, end = struct.pack("<I", self.bos), struct.pack("<I", self.eos)
        for a, b in byte_slices([len(t) for t in texts], SLICE_BYTES):
            rows = [segments(t) for t in texts[a:b]]
            new = [s for s in set().union(*rows) if s not in known and s not in known.older]
            cut = list(map(self.cut, new))
            unknown = [p for p in set().union(*cut) if p not in parts and p not in parts.older]
            for p in sorted(unknown):  # neighbours share the front of their tables
                parts[p] = self._coded(p)
            for s, c in zip(new, cut):
                known[s] = self._whole(c)
            del new, cut, unknown
            for row in rows:
                found = [known[s] for s in row]
                yield (b"".join([begin, *[p[0] for p in found], end]),
                       "".join([p[1] for p in found])[1:])
            known.age()
            parts.age()


@functools.lru_cache(maxsize=2)
def prefix_table(model_path: str) -> PrefixTable:
    """One table per worker process, so that later tasks find its caches filled."""
    return PrefixTable(model_path)


def _texts(batches: Iterator[pa.Array]) -> Iterator[list[str]]:
    for batch in batches:
        yield ["" if t is None else t for t in batch.to_pylist()]


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text",
                  ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` plus the ids (begin and end included) and the text decoded from them."""
    ids, decoded, both = free_names(docs, ids, decoded, "encoded")

    @F.arrow_udf(ENCODED)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = prefix_table(model_path)
        for texts in _texts(batches):
            rows = list(table.encode_all(texts))
            yield pa.StructArray.from_arrays(
                [pa.array([list(struct.unpack(f"<{len(i) // 4}I", i)) for i, _ in rows],
                          pa.list_(pa.int32())),
                 pa.array([d for _, d in rows], pa.string())], ["ids", "decoded"])

    return docs.withColumn(both, encode(text_of(text))).select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.col(f"{both}.ids").alias(ids), F.col(f"{both}.decoded").alias(decoded))


def piece_digests(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` plus the count and digest of the ids and the digest of the decoded text."""
    names = free_names(docs, "n_tokens", "ids_sha256", "decoded_sha256", "digest")

    @F.arrow_udf(DIGEST)
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = prefix_table(model_path)
        for texts in _texts(batches):
            counts, ids_sha, text_sha = [], [], []
            for ids, back in table.encode_all(texts):
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(names[3], digest(text_of(text))).select(
        *(F.col(f"`{c}`") for c in docs.columns),
        *(F.col(f"{names[3]}.{field}").alias(name)
          for field, name in zip(("n_tokens", "ids_sha256", "decoded_sha256"), names)))
