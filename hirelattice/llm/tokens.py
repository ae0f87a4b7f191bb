"""Token ids of many texts by the tokenizers library, each distinct piece of text encoded once.

Both kinds of byte-pair encoders used here part a text before they merge anything: before every run of
white space that follows another character, and between a letter and a mark such as a full stop. So a text
may be cut there, and the ids of its pieces in a row are the ids of the text. Pieces repeat, so their ids
are kept, up to a number of pieces, for as long as the worker process lives.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
import pyarrow as pa

from hirelattice.llm.words import buffers, slices

# the characters of Unicode's White_Space property
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECES = re.compile(f"[{_WHITE}]*(?:[A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff]+(?=[.,;:!?{_WHITE}]|$)|[^{_WHITE}]+)|[{_WHITE}]+")
# pieces kept at most; then the memory starts anew
KEPT = 800_000


def _bytes(*values: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


_BLANK, _MARK = _bytes(*range(9, 14), 32), _bytes(*b".,;:!?")
_LETTER = _bytes(*range(65, 91), *range(97, 123))
# second bytes, after 0xC3, of the letters from U+00C0 to U+00FF
_ACCENTED = _bytes(*(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)))


def _ends_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character beyond ASCII that ends before each place is white space."""
    a, b, c = (data[np.maximum(at - k, 0)] for k in (3, 2, 1))
    general = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    other = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    return general | other | ((b == 0xC2) & ((c == 0x85) | (c == 0xA0)))


def piece_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the pieces of UTF-8 texts ``data[at[i]:at[i + 1]]`` begin: at a text, before ASCII white space that follows another
    character, and at a mark that ends a run of Latin letters. White space beyond ASCII is cut nowhere."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    head = np.zeros(n + 1, bool)
    head[at] = True
    head = head[:n]
    blank = _BLANK[data]
    after = np.zeros(n, bool)
    after[1:] = blank[:-1]
    starts = head | (blank & ~after)
    wide = np.flatnonzero(starts[1:] & (data[:-1] >= 0x80)) + 1
    wide = wide[~head[wide]]
    starts[wide] = ~_ends_white(data, wide)
    letter = _LETTER[data]
    accent = np.flatnonzero(data == 0xC3)
    accent = accent[_ACCENTED[data[accent + 1]]]
    letter[accent] = letter[accent + 1] = True
    first = ~blank & (after | head)
    other = np.flatnonzero(~blank & ~letter)
    run = np.cumsum(first, dtype=np.int32)[other]
    new = np.ones(len(other), bool)
    new[1:] = run[1:] != run[:-1]
    other = other[new]
    starts[other[_MARK[data[other]]]] |= ~first[other[_MARK[data[other]]]]
    return np.flatnonzero(starts)


class _Index(dict):
    """Numbers pieces in the order they come; ``fresh`` collects those not encoded yet."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = k = len(self)
        self.fresh.append(piece)
        return k


class Encoder:
    """Ids by the tokenizer file at ``path``, without special tokens around the text."""

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """The worker's encoder for this file; workers are reused between tasks, and with them what is kept."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        kept = vars(tokenizers).setdefault("_kept_encoders", {})
        if path not in kept:
            kept[path] = cls(tokenizers.Tokenizer.from_file(path))
        return kept[path]

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._forget()

    def _forget(self) -> None:
        self.index = _Index()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first = np.zeros(1, np.int64)

    def _learn(self) -> None:
        pieces, self.index.fresh = self.index.fresh, []
        for low in range(0, len(pieces), 20_000):
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[low:low + 20_000], add_special_tokens=False)]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(sizes.sum()))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used:self.used + len(ids)] = ids
            self.first = np.concatenate([self.first, self.used + np.cumsum(sizes)])
            self.used += len(ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row as 32-bit integers, and how many of them each text has; null counts as empty."""
        if len(self.index) > KEPT:
            self._forget()
        data, at = buffers(texts)
        data, at = data[at[0]:at[-1]], at - at[0]
        begin = piece_starts(data, at)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        ends = np.append(begin, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
        known = np.fromiter(map(self.index.__getitem__, pieces.dictionary.to_pylist()), np.int64, len(pieces.dictionary))
        if self.index.fresh:
            self._learn()
        which = known[pieces.indices.to_numpy()]
        kept = pa.Array.from_buffers(pa.large_binary(), len(self.first) - 1, [None, pa.py_buffer(self.first * 4), pa.py_buffer(self.ids)])
        run = np.concatenate([[0], np.cumsum(np.diff(self.first)[which])])
        ids = np.frombuffer(kept.take(pa.array(which)).buffers()[2], np.uint32, int(run[-1])) if run[-1] else np.zeros(0, np.uint32)
        return ids, np.diff(run[np.searchsorted(begin, at)])


class PieceCounts:
    """How many ids texts have by several tokenizer files; each distinct piece is encoded once, and only its counts are kept."""

    _of: dict[tuple[str, ...], "PieceCounts"] = {}

    @classmethod
    def of(cls, paths: tuple[str, ...]) -> "PieceCounts":
        """The worker's counts for these files, kept between tasks."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if paths not in cls._of:
            import tokenizers

            cls._of[paths] = cls([tokenizers.Tokenizer.from_file(path) for path in paths])
        return cls._of[paths]

    def __init__(self, coders: list):
        self.coders = coders
        self._forget()

    def _forget(self) -> None:
        self.index, self.sizes = _Index(), np.zeros((len(self.coders), 0), np.int64)

    def _learn(self) -> None:
        pieces, self.index.fresh = self.index.fresh, []
        new = [[len(e.ids) for low in range(0, len(pieces), 20_000) for e in coder.encode_batch_fast(pieces[low:low + 20_000], add_special_tokens=False)]
               for coder in self.coders]
        self.sizes = np.concatenate([self.sizes, np.array(new, np.int64)], axis=1)

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Ids of each text (columns) by each tokenizer (rows); null and empty texts have none."""
        if len(self.index) > KEPT:
            self._forget()
        parts = [_PIECES.findall(t) if t else [] for t in texts]
        edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        at = np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(parts)), np.int64, int(edges[-1]))
        if self.index.fresh:
            self._learn()
        run = np.concatenate([np.zeros((len(self.coders), 1), np.int64), np.cumsum(self.sizes[:, at], axis=1)], axis=1)
        return run[:, edges[1:]] - run[:, edges[:-1]]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text, and where each text's begin."""
    first = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.full(first[-1], end, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out, first


def column_runs(column: pa.Array, limit: int = 1 << 22):
    """(from, to) of runs of texts of about ``limit`` bytes."""
    return ((rows.start, rows.stop) for rows in slices(buffers(column)[1], limit))


def text_runs(texts: list[str | None], limit: int = 1 << 20):
    """(from, to) of runs of texts of about ``limit`` characters."""
    low = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)
