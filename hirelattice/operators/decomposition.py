"""Truncated singular value decomposition of a table of vectors, and the silhouette of a clustering by plain distances."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hirelattice.operators.numbering import number_rows
from hirelattice.session import broadcast_if_small, cut

# directions beyond those asked for, and passes that sharpen them
EXTRA, PASSES = 10, 6
# numbers of a matrix that one row carries, sums that meet in one task, numbers the driver holds at most
CHUNK, FAN_IN, MOST = 1 << 16, 32, 1 << 25
# values of sparse rows that are multiplied at once
PIECE = 1 << 16
# vectors of a block: cut finer than WIDE only down to BLOCK, for SPLIT blocks a side, as every block meets every other; and rows compared at once
BLOCK, WIDE, SPLIT, ROWS = 2048, 32_768, 8, 64


def sparse_rows(weights: DataFrame, id_column: str, term_column: str, weight_column: str, terms: DataFrame | None = None) -> tuple[DataFrame, int]:
    """(id, at, value) with numbered terms, one row per id, from a long table; and how many terms there are.

    ``terms`` may hold the table's terms, each once, which saves a pass over it.
    """
    terms = weights.select(term_column).distinct() if terms is None else terms.select(term_column)
    numbered = cut(number_rows(terms, [term_column], "_number").select(term_column, (F.col("_number") - 1).cast("int").alias("_at")))
    pairs = weights.join(broadcast_if_small(numbered), term_column).groupBy(F.col(id_column).alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("_at", F.col(weight_column).cast("double").alias("_v")))).alias("_p"))
    return pairs.select("id", F.col("_p._at").alias("at"), F.col("_p._v").alias("value")), numbered.count()


def dense_rows(df: DataFrame) -> tuple[DataFrame, int]:
    """(id, at, value) of (id, vec); zeros are left out."""
    vec = F.col("vec").cast("array<double>")
    rows = df.filter("vec is not null").select("id", vec.alias("_v"))
    dim = rows.agg(F.max(F.size("_v"))).first()[0] or 0
    kept = F.filter(F.sequence(F.lit(0), F.size("_v") - 1), lambda i: F.get("_v", i) != 0)
    rows = rows.filter(F.size("_v") > 0).select("id", "_v", kept.alias("at"))
    return rows.select("id", "at", F.transform("at", lambda i: F.get("_v", i)).alias("value")), dim


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``PIECE`` values; a row is not cut."""
    for batch in batches:
        edge = batch.column("at").offsets.to_numpy() if batch.num_rows else [0]
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(edge, edge[low] + PIECE, "right")) - 1)
            yield batch.slice(low, min(high, batch.num_rows) - low)
            low = high


def _times(batch: pa.RecordBatch, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a batch times a matrix; and the rows' numbers, places and values."""
    at, value = batch.column("at"), batch.column("value")
    n = np.diff(at.offsets.to_numpy())
    row = np.repeat(np.arange(len(n)), n)
    places, values = at.flatten().to_numpy().astype(np.int64), value.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(n), matrix.shape[1]))
    if len(places):
        begins = (np.cumsum(n) - n)[n > 0]
        out[n > 0] = np.add.reduceat(values[:, None] * matrix[places], begins, axis=0)
    return out, row, places, values


def _summed(rows: DataFrame, work, size: int) -> np.ndarray:
    """``size`` numbers that ``work(batch, numbers)`` adds to, summed over all rows in a tree of tasks."""
    span = -(-size // CHUNK)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(size)
        for batch in _pieces(batches):
            work(batch, whole)
        part = TaskContext.get().partitionId()
        parts = [whole[k * CHUNK:(k + 1) * CHUNK] for k in range(span)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(span), pa.int32()), pa.array([part] * span, pa.int32()), pa.array(parts, pa.list_(pa.float64()))], ["chunk", "part", "total"])

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "part": pdf["part"].iloc[:1] // FAN_IN, "total": [np.sum(np.stack(pdf["total"]), axis=0)]})

    kind = "chunk int, part int, total array<double>"
    sums, tasks = rows.mapInArrow(partial, kind), rows.rdd.getNumPartitions()
    while tasks > 1:
        sums = sums.groupBy("chunk", F.expr(f"part div {FAN_IN}")).applyInPandas(added, kind)
        tasks = -(-tasks // FAN_IN)
    got = {r["chunk"]: r["total"] for r in sums.collect()}
    return np.concatenate([got[k] for k in range(span)]) if got else np.zeros(size)


@dataclass(frozen=True)
class Decomposition:
    """Singular values, falling; right vectors as columns; and the share of the variance each of them explains."""

    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    def transform(self, rows: DataFrame) -> DataFrame:
        """(id, vec): every row in the new directions. The sign of a direction is arbitrary."""
        shared = rows.sparkSession.sparkContext.broadcast(self.vectors)

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _pieces(batches):
                new = _times(batch, shared.value)[0]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(new), pa.list_(pa.float64()))], ["id", "vec"])

        return rows.mapInArrow(moved, f"id {rows.schema['id'].dataType.simpleString()}, vec array<double>")

    def table(self, rows: DataFrame) -> DataFrame:
        """(component, singular_value, explained) from the strongest on."""
        data = [(k + 1, float(s), float(v)) for k, (s, v) in enumerate(zip(self.values, self.explained))]
        return rows.sparkSession.createDataFrame(data, "component bigint, singular_value double, explained double")


def truncated_svd(rows: DataFrame, dim: int, n_components: int, seed: int = 42, passes: int = PASSES) -> Decomposition:
    """The strongest ``n_components`` directions of rows (id, at, value) with ``dim`` columns, without centring.

    A random basis of a few more directions is multiplied by A'A, one pass over the rows each time, and made orthogonal
    in between; the values then come from the small Gram matrix of A in that basis. A itself stays sparse and is never
    collected: tasks send sums of the size of the basis, which are added up in a tree, and the driver holds ``dim`` by
    ``n_components + EXTRA`` numbers. The number of components is held below the dimension.
    """
    k = max(1, min(n_components, dim))
    wide = min(dim, k + EXTRA)
    if dim * wide > MOST:
        raise ValueError(f"{dim} columns by {wide} directions are more than {MOST} numbers; keep fewer terms")
    if dim == 0:
        return Decomposition(np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    rows = cut(rows)
    spark = rows.sparkSession
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, wide)))[0]
    for _ in range(passes if wide < dim else 0):
        shared = spark.sparkContext.broadcast(basis)

        def again(batch, whole, shared=shared):
            out, row, places, values = _times(batch, shared.value)
            held, place = np.unique(places, return_inverse=True)
            total = whole.reshape(dim, wide)
            for k in range(wide):
                total[held, k] += np.bincount(place, values * out[row, k], len(held))

        basis = np.linalg.qr(_summed(rows, again, dim * wide).reshape(dim, wide))[0]
        shared.unpersist()
    shared = spark.sparkContext.broadcast(basis)

    def gram(batch, whole):
        # of A in the basis, the sums of its columns there; rows, squares and the sums of the columns of A
        out, _, places, values = _times(batch, shared.value)
        own = wide * wide + wide + 2
        whole[:own] += np.concatenate([(out.T @ out).ravel(), out.sum(axis=0), [batch.num_rows, (values * values).sum()]])
        np.add.at(whole[own:], places, values)

    sums = _summed(rows, gram, wide * wide + wide + 2 + dim)
    g, means = sums[:wide * wide].reshape(wide, wide), sums[wide * wide:wide * wide + wide]
    n, squares = sums[wide * wide + wide:wide * wide + wide + 2]
    power, turn = np.linalg.eigh(g)
    order = np.argsort(-power)[:k]
    power, turn = np.maximum(power[order], 0.0), turn[:, order]
    n = max(n, 1.0)
    variance = power / n - ((means / n) @ turn) ** 2
    total = squares / n - ((sums[-dim:] / n) ** 2).sum()
    return Decomposition(np.sqrt(power), basis @ turn, variance / total if total > 0 else np.zeros(k))


def silhouettes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(id, cluster, a, b, silhouette) of every row of (id, vec, cluster), by plain Euclidean distance.

    ``a`` is the mean distance to the others of its cluster, ``b`` the least mean distance to another cluster, the silhouette
    (b - a) / max(a, b), and 0 for the only row of a cluster. All pairs count: blocks of rows meet in tasks of bounded
    size, which send one sum per row and cluster on. Rows without a vector or cluster are left out.
    """
    rows = df.filter(F.col("vec").isNotNull() & F.col(cluster).isNotNull()).select(
        "id", F.col("vec").cast("array<double>").alias("vec"), F.col(cluster).alias("c"))
    rows = cut(rows)
    sizes = rows.groupBy("c").agg(F.count("*").alias("size"))
    names = [r["c"] for r in sizes.select("c").orderBy("c").collect()]
    if not names:
        return rows.select("id", F.col("c").alias("cluster"), *[F.lit(None).cast("double").alias(x) for x in ("a", "b", "silhouette")])
    number = {name: k for k, name in enumerate(names)}
    n = rows.count()
    parts = max(1, -(-n // max(BLOCK, WIDE)), min(-(-n // BLOCK), SPLIT))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left, right = rows.select(part.alias("q"), each.alias("o"), "id", "vec"), rows.select(each.alias("q"), part.alias("o"), "vec", "c")

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        out = np.zeros((0, len(names)))
        if len(a) and len(b):
            x, y = (np.stack(t["vec"].to_numpy()).astype(np.float64, copy=False) for t in (a, b))
            squares = (y * y).sum(1)[None]
            own = np.zeros((len(b), len(names)))
            own[np.arange(len(b)), [number[c] for c in b["c"].to_pylist()]] = 1.0
            out = np.zeros((len(a), len(names)))
            for low in range(0, len(a), ROWS):
                some = x[low:low + ROWS]
                out[low:low + ROWS] = np.sqrt(np.maximum((some * some).sum(1)[:, None] + squares - 2.0 * (some @ y.T), 0.0)) @ own
        ids = a["id"] if len(out) else a["id"].slice(0, 0)
        return pa.table({"id": ids, "sums": pa.array(list(out), pa.list_(pa.float64()))})

    keys = ["q", "o"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, f"id {rows.schema['id'].dataType.simpleString()}, sums array<double>")
    sums = found.select("id", F.posexplode("sums").alias("k", "x")).groupBy("id", "k").agg(F.sum("x").alias("x"))
    # one row per cluster
    index = F.broadcast(sizes.join(rows.sparkSession.createDataFrame([(v, k) for k, v in enumerate(names)], f"c {rows.schema['c'].dataType.simpleString()}, k int"), "c"))
    means = sums.join(index.select("k", "size", F.col("c").alias("other")), "k").join(rows.select("id", "c"), "id")
    same = F.col("other") == F.col("c")
    both = means.groupBy("id", F.col("c").alias("cluster")).agg(
        F.max(F.when(same & (F.col("size") > 1), F.col("x") / (F.col("size") - 1))).alias("a"), F.min(F.when(~same, F.col("x") / F.col("size"))).alias("b"))
    widest = F.greatest("a", "b")
    return both.withColumn("silhouette", F.when(F.col("a").isNull() | F.col("b").isNull() | (widest == 0), 0.0).otherwise((F.col("b") - F.col("a")) / widest))


def silhouette(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(n, silhouette): the mean over all rows, null where there are fewer than two clusters."""
    each = silhouettes(df, cluster)
    return each.agg(F.count("*").alias("n"), F.when(F.count("b") > 0, F.avg("silhouette")).alias("silhouette"))
