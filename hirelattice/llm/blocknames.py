"""Exact copies by block naming: equal texts, and only these, end with the same integer.

A text, A-Z in lower case, is cut into blocks of ``BLOCK`` bytes. All blocks are sorted and every distinct
block is named by its rank; then neighbouring names are written as one 16-byte block, sorted and named
again, until a text has one name left. Level and name are its identity: names come from a full sort of the
contents, so there are no collisions, and they don't depend on how rows were dealt to tasks.

The sort is a range partition on (block, row), so a block that a third of all rows hold is spread over
many tasks; a rank is counted within a task and shifted by what the tasks before it hold, a block that
crosses a border being counted once. Each level moves half the names of the one before.

Null and empty texts are equal. Of equal texts the row with the largest id stays; a null id is smaller than
any other, and of rows that repeat both text and id one stays. Other columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from hirelattice.llm.common import stored
from hirelattice.llm.words import buffers

BLOCK = 1024
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_RANKED = "row long, pos int, size int, part int, rank long, first binary, last binary"


def _cut(block: int):
    """Batches of (row, doc_id, text) as (row, pos, size, doc_id, sha, block); id and hash stand at pos 0 only."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            data = _LOWER[data[offsets[0]:offsets[-1]]]
            offsets = offsets - offsets[0]
            size = np.maximum(1, -(-np.diff(offsets) // block))
            edge = np.concatenate([[0], np.cumsum(size)])
            of = np.repeat(np.arange(len(size)), size)
            pos = np.arange(edge[-1]) - edge[of]
            starts = offsets[of] + pos * block
            blocks = pa.Array.from_buffers(
                pa.binary(), len(of), [None, pa.py_buffer(np.append(starts, offsets[-1]).astype(np.int32)), pa.py_buffer(data)])
            view = memoryview(data)
            digests = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            head = pa.array(np.where(pos == 0, of, 0), mask=pos > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(of)), pa.array(pos, pa.int32()), pa.array(size[of], pa.int32()),
                 batch.column("doc_id").take(head), pa.array(digests, pa.string()).take(head), blocks],
                ["row", "pos", "size", "doc_id", "sha", "block"])

    return cut


def _rank(carry: list[str]):
    """Number the distinct blocks of a sorted partition; a last row holds its ends and how many there are."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last, count, kept = TaskContext.get().partitionId(), None, None, 0, None
        for batch in batches:
            n, block = batch.num_rows, batch.column("block")
            if not n:
                continue
            new = np.ones(n, np.int64)
            new[1:] = pc.not_equal(block.slice(1), block.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            if last is None:
                first = block[0].as_py()
            else:
                new[0] = block[0].as_py() != last
            at = count + np.cumsum(new) - 1
            last, count, kept = block[n - 1].as_py(), int(at[-1]) + 1, batch
            none = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("pos"), batch.column("size"), pa.array(np.full(n, part), pa.int32()),
                 pa.array(at), none, none, *(batch.column(c) for c in carry)],
                ["row", "pos", "size", "part", "rank", "first", "last", *carry])
        if kept is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int64()), pa.array([-1], pa.int32()), pa.array([0], pa.int32()), pa.array([part], pa.int32()),
                 pa.array([count]), pa.array([first], pa.binary()), pa.array([last], pa.binary()),
                 *(pa.nulls(1, kept.schema.field(c).type) for c in carry)],
                ["row", "pos", "size", "part", "rank", "first", "last", *carry])

    return rank


def named(blocks: DataFrame, carry: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """``blocks(row, pos, size, block, carry...)`` with ``block`` replaced by ``name``, its rank among all distinct
    blocks; and the stored ranks within each task of the sort that the names are made from."""
    schema = ", ".join([_RANKED, *(f"`{c}` {blocks.schema[c].dataType.simpleString()}" for c in carry)])
    ranked = stored(
        blocks.repartitionByRange("block", "row", "pos").sortWithinPartitions("block").mapInArrow(_rank(carry), schema), label)
    # one row per task of the sort
    tasks = Window.orderBy("part")
    ends = ranked.where("pos < 0").select("part", "rank", "first", "last")
    ends = ends.withColumn("shared", F.coalesce((F.col("first") == F.lag("last").over(tasks)).cast("long"), F.lit(0)))
    before = F.sum(F.col("rank") - F.col("shared")).over(tasks.rowsBetween(Window.unboundedPreceding, 0)) - F.col("rank")
    shift = F.broadcast(ends.select("part", before.alias("shift")))
    return (ranked.where("pos >= 0").join(shift, "part")
            .select("row", "pos", "size", (F.col("rank") + F.col("shift")).alias("name"), *carry)), ranked


def _eight(c: str):
    return F.unhex(F.lpad(F.hex(c), 16, "0"))


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(row, doc_id, sha, level, name) for every row of ``docs(doc_id, text)``."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = texts.mapInArrow(_cut(block), f"row long, pos int, size int, doc_id {kind}, sha string, block binary")
    names, base = named(cut, ["doc_id", "sha"], "names-0")
    heads = names.where("pos = 0").select("row", "doc_id", "sha")
    done = [names.where("size = 1").select("row", F.lit(0).alias("level"), "name")]
    longest = base.agg(F.max("size")).first()[0] or 1
    level = 0
    while longest > 1:
        level += 1
        longest = (longest + 1) // 2
        at = F.col("pos") % 2
        pairs = names.where("size > 1").groupBy("row", F.expr("pos div 2").cast("int").alias("pos"), "size").agg(
            F.max(F.when(at == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(at == 1, F.col("name"))), F.lit(-1)).alias("b"))
        names, _ = named(
            pairs.select("row", "pos", F.expr("(size + 1) div 2").cast("int").alias("size"), F.concat(_eight("a"), _eight("b")).alias("block")),
            [], f"names-{level}")
        done.append(names.where("size = 1").select("row", F.lit(level).alias("level"), "name"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    return heads.join(whole, "row")


def exact_copies(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Of every row: ``doc_id, keep_id, group_size, kept, text_sha256, level, name``.

    The last two are the identity of its text, the hash that of the text in lower case.
    """
    rows = stored(identities(docs, block), "identities")
    groups = rows.groupBy("level", "name").agg(F.max(F.struct("doc_id", "row")).alias("stays"), F.count("*").alias("group_size"))
    groups = stored(groups.where("group_size > 1"), "equal-texts")
    stays = F.coalesce(F.col("stays.row"), F.col("row"))
    return rows.join(groups, ["level", "name"], "left").select(
        "doc_id", F.when(F.col("stays").isNull(), F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (stays == F.col("row")).alias("kept"),
        F.col("sha").alias("text_sha256"), "level", "name")
