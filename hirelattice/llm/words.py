"""Words of many texts as numpy arrays: positions and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n at least, kept per worker."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        grown = np.full(max(n, 1 << 20), base, dtype=U64)
        grown[0] = 1
        have = _POWERS[base] = np.cumprod(grown, dtype=U64)
    return have


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x`` and the salt."""
    z = x + U64((salt * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
    return z ^ (z >> U64(31))


@dataclass
class Words:
    """Words of ``rows`` texts; ``first[i]:first[i + 1]`` are those of text ``i``."""

    rows: slice
    data: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    base: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, kind)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at.astype(np.int64)


def slices(offsets: np.ndarray, limit: int) -> Iterator[slice]:
    """Runs of rows of about ``limit`` bytes; a longer row makes a run of its own."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield slice(low, min(high, n))
        low = high


def words_of(column: pa.Array, limit: int = 1 << 20) -> Iterator[Words]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column, A-Z in lower case, about ``limit`` bytes at a time."""
    data, offsets = buffers(column)
    for rows in slices(offsets, limit):
        low, high = offsets[rows.start], offsets[rows.stop]
        at = offsets[rows.start:rows.stop + 1] - low
        piece = _LOWER[data[low:high]]
        word = ~_SPACE[piece]
        head = np.zeros(len(piece) + 1, bool)
        head[at[:-1]] = True
        head = head[:-1]
        if len(piece):
            starts = word.copy()
            starts[1:] &= ~word[:-1] | head[1:]
            stops = word.copy()
            stops[:-1] &= ~word[1:] | head[1:]
            start, end = np.flatnonzero(starts), np.flatnonzero(stops) + 1
        else:
            start = end = np.zeros(0, np.int64)
        run = np.zeros(len(piece) + 1, U64)
        np.cumsum((piece.astype(U64) + U64(1)) * powers(_BASE, len(piece) + 1)[:len(piece)], out=run[1:])
        value = mix((run[end] - run[start]) * powers(_INVERSE, len(piece) + 1)[start])
        yield Words(rows, piece, value, start, end, np.searchsorted(start, at), at)


def shingles(words: Words, width: int = 5, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of every text, and where each text's hashes begin.

    With ``whole``, a text with fewer words, but one at least, has one: that of its whole sequence.
    """
    h, counts = words.hash, words.counts
    n = np.where(counts >= width, counts - width + 1, np.where(whole & (counts > 0), 1, 0))
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(words.first[:-1] - first[:-1], n) + np.arange(first[-1])
    left = np.repeat(words.first[1:], n) - at
    out = np.zeros(len(at), U64)
    for k in range(width):
        have = left > k
        part = h[np.minimum(at + k, len(h) - 1)] if len(h) else out
        out = out * U64(0xA24BAED4963EE407) + np.where(have, part, U64(0))
    return mix(out + np.minimum(left, width).astype(U64), 7), first
