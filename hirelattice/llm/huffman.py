"""Token files coded by a canonical length-limited Huffman code, in blocks that are decoded on their own.

A file row is a block of whole documents: their ids and token counts, the coded bits, and the bit offset
of every 128th token. The code is made from the counts of all ids by package-merge; code lengths alone
define it (shorter first, then by id). Decoding looks ``LONGEST`` bits up in a table, for all stretches
between offsets side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelattice.llm.common import stored
from hirelattice.llm.tokens import Encoder, column_runs, with_end

LONGEST = 18
STRETCH = 128
BLOCK_TOKENS = 1 << 17

BLOCK_SCHEMA = "part int, first_start long, tokens long, doc_ids array<long>, doc_tokens array<int>, offsets binary, bits binary"


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the best prefix code with none over ``longest``; 0 for ids that do not occur.

    Package-merge: at each level pairs of the level below become packages among the ids; the cheapest
    2n - 2 entries of the last level, followed down, say how often each id is counted.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids need codes of over {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    levels, row, single = [], weight, np.ones(len(weight), bool)
    for _ in range(longest - 1):
        levels.append(single)
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        at = np.argsort(both, kind="stable")
        row, single = both[at], at < len(weight)
    levels.append(single)
    take = 2 * len(used) - 2
    for single in reversed(levels):
        singles = int(single[:take].sum())
        lengths[order[:singles]] += 1
        take = 2 * (take - singles)
    return lengths


class Code:
    """The canonical code of given lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        spans = 1 << (LONGEST - self.lengths[order])
        begin = np.concatenate([[0], np.cumsum(spans)])
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = begin[:-1] >> (LONGEST - self.lengths[order])
        self.symbol = np.zeros(1 << LONGEST, np.uint32)
        self.symbol[:begin[-1]] = np.repeat(order, spans)
        self.skip = np.ones(1 << LONGEST, np.uint8)
        self.skip[:begin[-1]] = np.repeat(self.lengths[order], spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Coded bits, and the bit offset of every ``STRETCH``-th id."""
        sizes = self.lengths[ids]
        run = np.concatenate([[0], np.cumsum(sizes)])
        at = run[:-1]
        word = self.codes[ids] << (32 - sizes - (at & 7))
        out = np.zeros((run[-1] + 7) // 8 + 4, np.uint8)
        for lane in range(4):  # bits of different codes never overlap, so sums are unions
            out += np.bincount((at >> 3) + lane, (word >> (24 - 8 * lane)) & 255, len(out)).astype(np.uint8)
        return at[::STRETCH].astype("<u4").tobytes(), out.tobytes()

    def decode(self, offsets: bytes, bits: bytes, tokens: int) -> np.ndarray:
        if not tokens:
            return np.zeros(0, np.uint32)
        data = np.frombuffer(bits, np.uint8).astype(np.uint32)
        window = np.zeros(len(data), np.uint32)
        for lane in range(4):
            window[:len(data) - lane] |= data[lane:] << np.uint32(24 - 8 * lane)
        at = np.frombuffer(offsets, "<u4").astype(np.int64)
        out = np.zeros((STRETCH, len(at)), np.uint32)
        last = len(window) - 1
        for k in range(STRETCH):
            look = (window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> np.uint32(32 - LONGEST)
            out[k] = self.symbol[look]
            at += self.skip[look]
        return out.T.reshape(-1)[:tokens]


def token_table(documents: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Stored ``part, ahead, doc_id, tokens, ids`` in ascending order of doc_id, null first, ties by a hash of the text.

    Texts are range-partitioned, not gathered: ``part`` counts the ranges and ``ahead`` the tokens of one before a row.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, ahead = Encoder.of(tokenizer), TaskContext.get().partitionId(), 0
        kind = np.uint16 if encoder.width == 2 else np.uint32
        for batch in batches:
            texts = batch.column("text")
            for low, high in column_runs(texts):
                ids, first = with_end(*encoder.encode(texts.slice(low, high - low)), end)
                n = high - low
                blobs = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((first * encoder.width).astype(np.int32).tobytes()), pa.py_buffer(ids.astype(kind).tobytes())])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, part, np.int32)), pa.array(ahead + first[:-1]), batch.column("doc_id").slice(low, n), pa.array(np.diff(first)), blobs],
                    names=["part", "ahead", "doc_id", "tokens", "ids"])
                ahead += int(first[-1])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.mapInArrow(encode, "part int, ahead long, doc_id long, tokens long, ids binary"), "token-table")


def id_counts(table: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all rows; at most ``vocabulary`` sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(vocabulary, np.int64)
        for batch in batches:
            width, some, size = _width(batch), [], 0
            for blob in batch.column("ids"):
                some.append(blob.as_buffer())
                size += len(some[-1])
                if size > 1 << 22:
                    seen += np.bincount(np.frombuffer(b"".join(some), width), minlength=vocabulary)
                    some, size = [], 0
            seen += np.bincount(np.frombuffer(b"".join(some), width), minlength=vocabulary)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used])], names=["id", "n"])

    sums = table.select("ids", "tokens").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for row in sums.collect():
        counts[row["id"]] = row["n"]
    return counts


def _width(batch: pa.RecordBatch) -> type:
    """The integer type of a batch's ids, from the first row that has any."""
    for blob, n in zip(batch.column("ids"), batch.column("tokens").to_numpy()):
        if n:
            return np.uint16 if len(blob.as_buffer()) == 2 * n else np.uint32
    return np.uint16


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end: int = 2) -> None:
    """Write the token files of ``documents(doc_id, text)`` under ``path``: ``blocks``, and ``lengths`` with the code that reads them.

    Null texts count as empty. Blocks hold whole documents, about 131 072 tokens.
    """
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(tokenizer).get_vocab_size()
    table = token_table(documents, tokenizer, end)
    lengths = code_lengths(id_counts(table, max(vocabulary, end + 1)))
    # one row per partition
    before, begin = 0, {}
    for row in table.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect():
        begin[row["part"]] = before
        before += row["n"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, held, size = Code(lengths), [], 0

        def block() -> pa.RecordBatch:
            part, ahead = held[0][:2]
            ids = np.concatenate([x[4] for x in held])
            offsets, bits = code.encode(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([begin[part] + ahead]), pa.array([len(ids)]),
                pa.array([[x[2] for x in held]], pa.list_(pa.int64())), pa.array([[x[3] for x in held]], pa.list_(pa.int32())),
                pa.array([offsets], pa.binary()), pa.array([bits], pa.binary())],
                names=["part", "first_start", "tokens", "doc_ids", "doc_tokens", "offsets", "bits"])

        for batch in batches:
            width = _width(batch)
            for part, ahead, doc, n, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "ahead", "doc_id", "tokens")), batch.column("ids")):
                # a task may read pieces of several parts, and those of one part in any order
                if held and (part != held[0][0] or ahead != held[0][1] + size or size >= BLOCK_TOKENS):
                    yield block()
                    held, size = [], 0
                held.append((part, ahead, doc, n, np.frombuffer(blob.as_buffer(), width)))
                size += n
        if held:
            yield block()

    table.select("part", "ahead", "doc_id", "tokens", "ids").mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    # one row per id in use
    used = np.flatnonzero(lengths)
    code = [(int(i), int(lengths[i])) for i in used]
    documents.sparkSession.createDataFrame(code, "id int, length int").coalesce(1).write.parquet(f"{path}/lengths")


def open_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the token files under ``path``, as ``read_tokens`` gives them, from the files alone."""
    code = spark.read.schema("id int, length int").parquet(f"{path}/lengths").collect()
    lengths = np.zeros(1 + max((r["id"] for r in code), default=0), np.uint8)
    for r in code:
        lengths[r["id"]] = r["length"]
    return read_tokens(spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks"), lengths)


def read_tokens(files: DataFrame, lengths: np.ndarray) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit integers) from rows of token files, in any order."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                ids = code.decode(row["offsets"], row["bits"], row["tokens"]).astype("<u4")
                counts = np.array(row["doc_tokens"], np.int64)
                first = np.concatenate([[0], np.cumsum(counts)])
                blobs = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer((first * 4).astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["first_start"] + first[:-1]), pa.array(counts), blobs], names=["doc_id", "start", "n_tokens", "ids"])

    return files.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
