"""Batch text encoding with a pluggable encoder."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WORD = re.compile(r"\w{2,}")


class HashingEncoder:
    """Word counts in a fixed number of buckets; the bucket is the head of the word's MD5."""

    def __init__(self, dim: int = 256):
        self.dim = dim
        self._bucket: dict[str, int] = {}

    def _of(self, word: str) -> int:
        bucket = self._bucket.get(word)
        if bucket is None:
            if len(self._bucket) > 500_000:
                self._bucket.clear()
            bucket = self._bucket[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dim
        return bucket

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts):
            buckets = [self._of(w) for w in WORD.findall(text.lower())]
            if buckets:
                row += np.bincount(buckets, minlength=self.dim)
        return out


def encode(
    df: DataFrame, id_column: str, text_column: str, encoder_factory: Callable[[], Callable[[Sequence[str]], np.ndarray]],
    batch: int = 32,
) -> DataFrame:
    """(id, vec) for every text. The factory is called once per task, so a model is loaded once;
    the encoder gets whole texts in batches; null text is encoded as empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_factory()
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                some = rows.slice(at, batch)
                # only the texts of one batch are Python strings at a time
                part = np.asarray(encoder([x or "" for x in some.column("text").to_pylist()]), dtype=np.float64)
                yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(list(part), pa.list_(pa.float64()))], ["id", "vec"])

    rows = df.selectExpr(f"cast({id_column} as bigint) as id", f"{text_column} as text")
    return rows.mapInArrow(run, "id bigint, vec array<double>")
