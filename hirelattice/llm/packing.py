"""Vector bin packing of token pieces into sequences under several limits at once.

A document's ids are cut into whole sequences and one rest. Rests are dealt to groups of a few thousand,
and within a group sequences are filled one after the other: of all rests that fit, the next is the one
whose demand (tokens, segments, loss-bearing tokens, each as a share of its limit) has the largest dot
product with what the sequence has left. When nothing fits any more, a rest is cut to fill a gap worth it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hirelattice.llm.common import stored, total
from hirelattice.llm.tokens import Encoder, column_runs, with_end

# rests of one group, whose last sequence is the only one that may stay partly empty
GROUP = 2048
# a gap of fewer tokens is left to padding, as cutting a document for it costs more than it saves
LEAST_CUT = 16


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


def fill(sizes: np.ndarray, loss: np.ndarray, limits: Limits) -> list[tuple[int, int, int, int, int]]:
    """(piece, from, length, sequence, offset) for rests of ``sizes`` tokens, at most ``limits.tokens`` each.

    ``loss`` says how many of a rest's tokens, the last ones, bear loss. A cut leaves the rest's remainder
    for a later sequence. Every token is placed once, and no sequence passes a limit.
    """
    cap = np.array([limits.tokens, limits.segments, limits.loss], float)
    piece = np.flatnonzero(sizes > 0)  # those not placed whole yet; demand and share are theirs
    done = np.zeros(len(sizes), np.int64)
    demand = np.stack([sizes, np.ones(len(sizes), np.int64), np.minimum(loss, sizes)], axis=1).astype(float)[piece]
    share = demand / cap
    out: list[tuple[int, int, int, int, int]] = []
    sequence = -1
    while len(piece):
        sequence += 1
        room, at = cap.copy(), 0
        while len(piece):
            fits = (demand[:, 0] <= room[0]) & (demand[:, 1] <= room[1]) & (demand[:, 2] <= room[2])
            worth = np.where(fits, share @ (room / cap), -1.0)
            k = int(worth.argmax())
            if fits[k]:
                take = int(demand[k, 0])
            else:
                gap = int(room[0])
                if room[1] < 1 or gap < LEAST_CUT:
                    break
                k = int(demand[:, 0].argmax())
                still = int(demand[k, 0] - demand[k, 2])  # tokens of it that bear no loss come first
                take = min(gap, int(demand[k, 0]) - 1, still + int(room[2]))
                if take < LEAST_CUT:
                    break
            bearing = max(0, take - int(demand[k, 0] - demand[k, 2]))
            out.append((int(piece[k]), int(done[piece[k]]), take, sequence, at))
            room -= (take, 1, bearing)
            at += take
            done[piece[k]] += take
            demand[k] -= (take, 0, bearing)
            share[k] = demand[k] / cap
            if demand[k, 0] <= 0:
                for held in (piece, demand, share):
                    held[k:-1] = held[k + 1:]
                piece, demand, share = piece[:-1], demand[:-1], share[:-1]
    return out


def place(pieces: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``piece, cut, length, sequence, offset`` for stored ``pieces(piece, tokens, loss)`` of unique ids.

    Pieces meet in groups by a hash of their unique id, so no group can be hot, and a retried task packs alike.
    """
    (n,) = total(pieces, F.count("*"))
    groups = max(1, round(n / GROUP))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece")
        placed = fill(rows["tokens"].to_numpy(), rows["loss"].to_numpy(), limits)
        at, cut, length, sequence, offset = (np.array(c, np.int64) for c in zip(*placed)) if placed else [np.zeros(0, np.int64)] * 5
        group = int(rows["part"].iloc[0])
        return pd.DataFrame({"piece": rows["piece"].to_numpy()[at], "cut": cut, "length": length, "sequence": (group << 32) + sequence, "offset": offset})

    parted = pieces.select("piece", "tokens", "loss", F.pmod(F.xxhash64("piece"), F.lit(groups)).alias("part"))
    return parted.groupBy("part").applyInPandas(pack, "piece long, cut long, length long, sequence long, offset long")


def token_pieces(documents: DataFrame, tokenizer: str, end: int, limit: int = 1024) -> DataFrame:
    """Stored rows of ``documents(doc_id, text)``: the whole sequences of a document in one row, its rest in another.

    ``piece`` is unique. ``ids`` are little-endian integers of ``width`` bytes. Null texts count as empty; every
    document ends in the id ``end``, so each has a rest or a whole sequence at least.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder.of(tokenizer)
        kind = np.uint16 if encoder.width == 2 else np.uint32
        piece = TaskContext.get().partitionId() << 36
        whole = piece
        for batch in batches:
            texts = batch.column("text")
            for low, high in column_runs(texts):
                ids, first = with_end(*encoder.encode(texts.slice(low, high - low)), end)
                n = np.diff(first)
                full = n // limit * limit
                has = [np.flatnonzero(full > 0), np.flatnonzero(n > full)]
                at = np.concatenate(has)
                start = np.concatenate([np.zeros(len(has[0]), np.int64), full[has[1]]])
                size = np.concatenate([full[has[0]], (n - full)[has[1]]])
                order = np.argsort(at * 2 + (start > 0), kind="stable")
                at, start, size = at[order], start[order], size[order]
                spans = np.concatenate([[0], np.cumsum(size)])
                data = ids.astype(kind).tobytes()
                blobs = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((spans * encoder.width).astype(np.int32).tobytes()), pa.py_buffer(data)])
                sequences = np.where(size % limit == 0, size // limit, 0)
                begin = whole + np.cumsum(sequences) - sequences
                whole += int(sequences.sum())
                yield pa.RecordBatch.from_arrays([
                    pa.array(piece + np.arange(len(at))), batch.column("doc_id").slice(low, high - low).take(pa.array(at)),
                    pa.array(start), pa.array(size), pa.array(n[at]), pa.array(begin), pa.array(sequences > 0), blobs],
                    names=["piece", "doc_id", "start", "tokens", "doc_tokens", "first_sequence", "whole", "ids"])
                piece += len(at)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(cut, "piece long, doc_id long, start long, tokens long, doc_tokens long, first_sequence long, whole boolean, ids binary"), "pieces")


def pack_documents(documents: DataFrame, tokenizer: str, end: int = 0, limits: Limits = Limits()) -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` for every piece of every document.

    The first token of a document has nothing before it and bears no loss. A document without an id is
    packed like any other; repeated rows are packed as often as they occur; an empty table gives no pieces.
    """
    pieces = token_pieces(documents, tokenizer, end, limits.tokens)
    rests = pieces.where("not whole")
    loss = F.col("tokens") - F.when(F.col("start") == 0, 1).otherwise(0)
    placed = place(rests.select("piece", "tokens", loss.alias("loss")), limits)
    # a rest's row meets its few cuts: both sides are dealt by a unique id
    width = (F.octet_length("ids") / F.col("tokens")).cast("int")
    packed = rests.join(placed, "piece").select(
        "doc_id", (F.col("start") + F.col("cut")).alias("start"), "length", "doc_tokens", (F.col("sequence") * 2).alias("sequence_id"), "offset",
        F.substring("ids", (F.col("cut") * width + 1).cast("int"), (F.col("length") * width).cast("int")).alias("ids"))
    size = limits.tokens
    whole = pieces.where("whole").withColumn("width", width).select(
        "*", F.explode(F.sequence(F.lit(0), (F.col("tokens") / size).cast("int") - 1)).alias("k"))
    cut = whole.select(
        "doc_id", (F.col("start") + F.col("k") * size).alias("start"), F.lit(size).cast("long").alias("length"), "doc_tokens",
        ((F.col("first_sequence") + F.col("k")) * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.substring("ids", F.col("k") * size * F.col("width") + 1, size * F.col("width")).alias("ids"))
    return packed.union(cut)


def wide_crc32(ids: str = "ids", length: str = "length"):
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers, from binary ids of any width."""

    @F.arrow_udf("long")
    def crc(blob: pa.Array, n: pa.Array) -> pa.Array:
        import zlib

        out = []
        for b, k in zip(blob, n.to_numpy()):
            data = b.as_buffer()
            kind = np.uint16 if len(data) == 2 * k else np.uint32
            out.append(zlib.crc32(np.frombuffer(data, kind).astype("<u4").tobytes()))
        return pa.array(out, pa.int64())

    return crc(F.col(ids), F.col(length))
