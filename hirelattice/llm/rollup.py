"""Token counts kept up to date by signed deltas: additive totals by source, language and tokenizer version.

A change log holds one row per document and change: its key, how many documents and tokens it adds (or
takes away), and the batch that brings it. A batch's summed deltas are written to a folder of their own, and
the batch comes into being by one rename of a small file to its name, which must not exist yet: committing a
batch again, at once or by a second writer, adds nothing, and never mixes with what is there. Folding a long
history keeps the names of its batches. The totals are the sum of all batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelattice.llm.common import stored
from hirelattice.llm.tokens import PieceCounts, text_runs
from hirelattice.operators.bucketed import _Files

KEYS = ("source", "lang", "tokenizer")
_SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"


def token_counts(documents: DataFrame, paths: dict[str, str]) -> DataFrame:
    """``doc_id, source, lang, h, c`` and a column per tokenizer of ``paths``: the ids that its file gives the whole text.

    ``h`` and ``c`` are hashes of the text, null ``c`` for a null text, which has no tokens, like an empty one.
    """
    names, files = list(paths), tuple(paths.values())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = PieceCounts.of(files)
        for batch in batches:
            for low, high in text_runs(batch.column("text").to_pylist()):
                part = batch.slice(low, high - low)
                found = counts.count(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, found)], names=[*part.schema.names[:-1], *names])

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("c"), "text")
    columns = ", ".join(f"`{name}` long" for name in names)
    return rows.mapInArrow(count, f"doc_id long, source string, lang string, h long, c long, {columns}")


def without_copies(counted: DataFrame) -> DataFrame:
    """``counted`` by distinct row with ``n``, how often it is there, and ``gone``, how many of these are copies of another row.

    Of rows with equal texts one stays: the lowest id, then the lowest source and language; nulls come last among ids, else
    first. Null texts are no copies. A text that many rows share costs a row per distinct document.
    """
    keys = counted.columns
    rows = stored(counted.groupBy(*keys).agg(F.count("*").alias("n")), "counted")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "source", "lang")
    first = stored(rows.where("c is not null").groupBy("h", "c").agg(F.min(order).alias("first"), F.sum("n").alias("held")).where("held > 1").drop("held"), "copied")
    stays = (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("source").eqNullSafe(F.col("first.source")) & F.col("lang").eqNullSafe(F.col("first.lang")))
    gone = F.when(F.col("first").isNull(), 0).when(stays, F.col("n") - 1).otherwise(F.col("n"))
    return rows.join(first, ["h", "c"], "left").select(*keys, "n", gone.cast("long").alias("gone"))


def deltas(rows: DataFrame, tokenizer: str, tokens: str, sign: int, docs: str | None = None) -> DataFrame:
    """Signed changes of ``rows(source, lang, ...)``: +1 inserts them, -1 deletes them. A revision is both.

    ``docs`` is a column that says for how many documents a row stands (one, if there is none).
    """
    times = F.col(docs) * sign if docs else F.lit(sign)
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), times.cast("long").alias("docs"), (F.col(tokens) * times).cast("long").alias("tokens"))


class TokenTotals:
    """Totals under one folder: ``data`` holds a folder per write, ``batch`` a file per committed batch that names its folder.

    ``folded`` lists the batches whose sums came in with another one. Batch names may hold any characters.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self._files = spark, _Files(spark, path)

    @property
    def path(self) -> str:
        return self._files.base

    def _held(self, name: str) -> bool:
        return self._files.fs.exists(self._files.path(name))

    def committed(self, batch: str) -> bool:
        return self._held(f"batch/{quote(batch, safe='')}") or self._held(f"folded/{quote(batch, safe='')}")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add ``changes`` once; False if the batch is already there.

        A job that dies leaves a folder that no batch names. Of two writers of one batch one makes the rename,
        the other's folder stays unread. Keys may be null.
        """
        if self.committed(batch):
            return False
        folder = f"data/{uuid.uuid4().hex}"
        # a few rows per key and task meet here, so no key can be hot; keys that sum to nothing need no row
        sums = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")
        sums.write.parquet(f"{self.path}/{folder}")
        return self._files.create(f"batch/{quote(batch, safe='')}", folder)

    def batches(self) -> list[str]:
        """The names of all batches, folded ones included."""
        return sorted({unquote(n) for kind in ("batch", "folded") for n in self._files.names(kind)})

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens`` of what is left after all batches."""
        paths = [f"{self.path}/{self._files.read(f'batch/{n}')}" for n in self._files.names("batch")]
        rows = self.spark.read.schema(_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], _SCHEMA)
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")

    def compact(self, into: str) -> "TokenTotals":
        """Fold all batches into one under another, empty folder. None of them can be committed there again.

        Batches that come in here while it runs are not carried over; stop the writers first.
        """
        other = TokenTotals(self.spark, into)
        if other.batches():
            raise ValueError(f"{into} holds batches already")
        names, sums = self.batches(), self.totals()
        for name in names:
            other._files.create(f"folded/{quote(name, safe='')}", "")
        other.commit(f"fold-{uuid.uuid4().hex}", sums)
        return other
