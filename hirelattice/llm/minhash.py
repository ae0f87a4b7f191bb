"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and components.

Documents of one shingle set are one node from the start. SuperMinHash gives every shingle a random
permutation of the signature's places; in round j a shingle offers the value j + u to the j-th place of
its permutation, so a text whose places are all below j stops there. Bands of the signature are bucket
keys. Inside a bucket documents are linked to one of them first (a star), which joins groups of copies
of any size by as many pairs as they have members. After that only buckets with several components are
opened: the full sets of their members are compared block by block inside tasks, and a block gives a forest
of its links, so pairs are never rows. Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hirelattice.llm.common import connected_components, discard, stored
from hirelattice.llm.words import U64, Words, mix, shingles, words_of

BANDS, ROWS = 40, 6
PLACES = BANDS * ROWS
# members of a bucket, and their shingles, that make one block on average at most
MEMBERS, SHINGLES = 512, 1 << 21
# shingles that are held as columns at once
COLUMNS = 1 << 13


def superminhash(items: np.ndarray, first: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Signatures (texts x places) of the 64-bit items ``first[i]:first[i + 1]`` of each text; empty texts get all ones.

    The upper half of a value is the round and the lower half the random part, so smaller is earlier.
    """
    n = len(first) - 1
    counts = np.diff(first)
    best = np.full((n, places), np.iinfo(np.uint64).max, dtype=U64)
    flat = best.reshape(-1)
    live = np.flatnonzero(counts)
    text = np.repeat(live, counts[live])
    at = items
    order = None
    for j in range(places):
        draw = mix(at, 2 * j + 1)
        k = j + ((draw >> U64(32)) * U64(places - j) >> U64(32)).astype(np.int64)
        value = (U64(j) << U64(32)) | (draw & U64(0xFFFFFFFF))
        if order is None:
            spot = k
        else:
            row = np.arange(len(at))
            spot = order[row, k].astype(np.int64)
            order[row, k] = order[row, j]
        np.minimum.at(flat, text * places + spot, value)
        open_ = best[live].max(axis=1) >= (U64(j + 1) << U64(32))
        if not open_.any():
            break
        keep = np.zeros(n, bool)
        keep[live[open_]] = True
        stay = keep[text]
        if order is None:
            last = k[stay]
            order = np.empty((len(last), places), np.uint8)
            order[:] = np.arange(places, dtype=np.uint8)
            order[np.arange(len(last)), last] = 0
        else:
            order = order[stay]
        at, text, live = at[stay], text[stay], live[open_]
    return best


def _sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, and where each text's begin."""
    items, first = shingles(words)
    for low, high in zip(first[:-1], first[1:]):
        items[low:high].sort()
    new = np.ones(len(items), bool)
    new[1:] = items[1:] != items[:-1]
    new[first[:-1][np.diff(first) > 0]] = True
    counts = np.concatenate([[0], np.cumsum(new)])
    return items[new], counts[first]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    run = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    return run[first[1:]] - run[first[:-1]]


def _digest(items: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a set, whatever the order of its items."""
    return _sums(mix(items, 11), first).view(np.int64), _sums(mix(items, 12), first).view(np.int64)


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.reshape(-1).view(np.int64))


def _lists(values: np.ndarray, width: int) -> pa.Array:
    n = values.size // width
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), _longs(values))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in words_of(batch.column("text")):
            items, first = _sets(words)
            one, two = _digest(items, first)
            places = superminhash(items, first)
            bands = np.zeros((len(places), BANDS), U64)
            for r in range(ROWS):
                bands = mix(bands * U64(3) + places[:, r::ROWS], 31)
            bands = mix(bands + np.arange(BANDS, dtype=U64), 41)
            ids = batch.column("doc_id").slice(words.rows.start, len(first) - 1)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(first)), pa.array(one), pa.array(two), _lists(bands, BANDS)],
                names=["doc_id", "n_shingles", "k1", "k2", "bands"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the asked nodes; a row that says the same again within a task is left out."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for words in words_of(batch.column("text")):
            items, first = _sets(words)
            one, two = _digest(items, first)
            low, n = words.rows.start, len(first) - 1
            node, k1, k2 = (batch.column(c).slice(low, n).to_numpy() for c in ("doc_id", "k1", "k2"))
            asked = (k1 == one) & (k2 == two)
            for i in np.flatnonzero(asked):
                mark = (int(node[i]), int(one[i]))
                asked[i] = mark not in seen
                seen.add(mark)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), _longs(items))
            yield pa.RecordBatch.from_arrays([pa.array(node), lists], names=["node", "items"]).filter(pa.array(asked))


def _sets_of(documents: DataFrame, nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """Stored ``node, items`` of the ``asked(node)``, each once."""
    asked = asked.join(nodes.select("node", "k1", "k2"), "node")
    texts = documents.select("doc_id", "text").join(asked.withColumnRenamed("node", "doc_id"), "doc_id")
    return stored(texts.mapInArrow(_full_sets, "node long, items array<long>"), "sets")


def _confirmed(documents: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ``pairs(a, b)`` whose full sets have at least three quarters of their union in common."""
    pairs = stored(pairs, "pairs")
    sets = _sets_of(documents, nodes, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    left, right = sets.toDF("a", "x"), sets.toDF("b", "y")
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    links = stored(both.where("100 * common >= 75 * (size(x) + size(y) - common)").select("a", "b").distinct(), "links")
    discard(sets)
    return links


def linked(items: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether the sets ``items[first[i]:first[i + 1]]`` have three quarters of their union in common, for each two different ``i``."""
    n, sizes = len(first) - 1, np.diff(first)
    _, column, count = np.unique(items, return_inverse=True, return_counts=True)
    # a shingle of one set alone adds nothing
    shared = count > 1
    column, row = (np.cumsum(shared) - 1)[column][shared[column]], np.repeat(np.arange(n), sizes)[shared[column]]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    common = np.zeros((n, n), np.int64)
    for low in range(0, int(shared.sum()), COLUMNS):
        some = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        held = np.zeros((n, min(COLUMNS, int(shared.sum()) - low)), np.float32)
        held[row[some], column[some] - low] = 1
        common += (held @ held.T).astype(np.int64)
    return 100 * common >= 75 * (sizes[:, None] + sizes[None, :] - common)


def _forest(members: pa.Table) -> pa.Table:
    """``a, b``: a forest of the links between different components among the members of two blocks."""
    node, component = (members.column(c).to_numpy() for c in ("node", "component"))
    lists = members.column("items").combine_chunks()
    items, first = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    near = linked(items, first) & (component[:, None] != component[None, :])
    todo, a, b = near.any(axis=1), [], []
    for start in np.flatnonzero(todo):
        ahead = [start] if todo[start] else []
        todo[start] = False
        while ahead:
            at = ahead.pop()
            new = np.flatnonzero(near[at] & todo)
            todo[new] = False
            a += [node[at]] * len(new)
            b += node[new].tolist()
            ahead += new.tolist()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _links_between(documents: DataFrame, nodes: DataFrame, placed: DataFrame) -> DataFrame:
    """Stored ``a, b``: links that connect all members of a bucket of ``placed(band, node, component)`` which are linked but in different components.

    Buckets of the same members are opened once. A large one is cut into blocks, each two of which meet in one task.
    """
    digest = lambda k: F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(20,0)"))
    sized = placed.join(nodes.groupBy("node").agg(F.max("n").alias("n")), "node")
    mixed = sized.groupBy("band").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"), F.sum("n").alias("total"), digest(1).alias("d1"), digest(2).alias("d2"))
    blocks = F.greatest(F.ceil(F.col("size") / MEMBERS), F.least(F.ceil(F.col("total") / SHINGLES), F.col("size"))).cast("int")
    mixed = mixed.where("x <> y").groupBy("d1", "d2", "size").agg(F.min("band").alias("band"), F.max("total").alias("total")).select("band", blocks.alias("blocks"))
    member = stored(placed.join(stored(mixed, "mixed"), "band"), "members")
    sets = _sets_of(documents, nodes, member.select("node").distinct())
    block = member.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = block.select("band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "component").join(sets, "node")
    links = stored(met.groupBy("band", "low", "high").applyInArrow(_forest, "a long, b long").distinct(), "links")
    discard(sets)
    return links


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents(doc_id, text)``.

    Texts without words have an empty set and link with nothing; so do rows without an id, whose
    component is null and which are kept. Rows that share an id and a set are one document.
    """
    sketch = stored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _sketch, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"), "sketch")
    linked = sketch.where("n_shingles > 0 and doc_id is not null")
    nodes = stored(linked.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "nodes")
    entries = nodes.select("node", F.explode("bands").alias("band"))
    hubs = stored(entries.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n"), "hubs")
    shared = stored(entries.join(hubs, "band"), "shared")
    tree = shared.where("node <> hub").groupBy(F.col("node").alias("a")).agg(F.min("hub").alias("b"))
    links = _confirmed(documents, nodes, tree)
    groups = stored(connected_components(links), "groups")
    # what stars have left: members of a bucket in different components
    placed = stored(shared.join(groups, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component")), "placed")
    more = _links_between(documents, nodes, placed)
    if not more.isEmpty():
        groups = stored(connected_components(links.union(more)), "groups")
    # an id can stand for several sets if rows share it; the sets of one id are joined through it
    named = nodes.select("k1", "k2", "node").join(groups, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component_id"))
    joined = sketch.select("doc_id", "n_shingles", "k1", "k2").join(stored(named, "named"), ["k1", "k2"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
