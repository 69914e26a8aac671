"""Words of Arrow text batches as arrays: positions and 64-bit hashes, no Python loop per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from medallion.llm.common import byte_slices

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PIECE = 1 << 20
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, _PIECE + 4096)
        _powers[:] = [np.cumprod(np.concatenate(
            [[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (_BASE, _INVERSE)]
    return _powers


@dataclass
class Words:
    """``raw`` bytes of the rows laid end to end; ``first`` word of each row (one more at
    the end), ``start`` and ``end`` byte and ``hash`` (lower-cased) of each word."""

    raw: np.ndarray
    row_start: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def words_of(texts: pa.Array) -> Words:
    texts = texts.cast(pa.large_binary())
    n, buffers = len(texts), texts.buffers()
    bounds = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + n + 1]
    raw = (np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8))
    raw = raw[bounds[0]:bounds[-1]]
    bounds = bounds - bounds[0]
    space = SPACE[raw]
    row = np.zeros(len(raw) + 1, bool)
    row[bounds] = True
    after = np.concatenate([[True], space[:-1]]) | row[:-1] if len(raw) else row[:0]
    before = np.concatenate([space[1:], [True]]) | row[1:] if len(raw) else row[:0]
    start = np.flatnonzero(~space & after)
    end = np.flatnonzero(~space & before) + 1
    hashes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        # whole words of about one piece of bytes; a longer word stands alone
        stop = max(at + 1, int(np.searchsorted(end, start[at] + _PIECE, "right")))
        lo, hi = int(start[at]), int(end[stop - 1])
        power, inverse = _power_tables(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_TABLE[_LOWER[raw[lo:hi]]] * power[:hi - lo], out=total[1:])
        a, b = start[at:stop] - lo, end[at:stop] - lo
        hashes[at:stop] = mix((total[b] - total[a]) * inverse[a]
                              + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = stop
    return Words(raw, bounds, np.searchsorted(start, bounds), start, end, hashes)


def sliced(texts: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, Words]]:
    """Words of row ranges of about ``limit`` bytes."""
    import pyarrow.compute as pc

    sizes = pc.binary_length(texts).to_pylist()
    for a, b in byte_slices(sizes, limit):
        yield a, b, words_of(texts.slice(a, b - a))
