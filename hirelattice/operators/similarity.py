"""Exact nearest neighbours and similarity counts between two vector tables.

Vectors are compared block by block with matrix products inside Arrow tasks; pairs are never rows.
A large corpus is first divided into cells around pivot vectors. The triangle inequality then tells
which cells can hold a better neighbour than those already found, so the others are not opened and
the answer is still exact. Where the cells rule out so little that opening them moves more rows than
comparing all blocks does, all blocks are compared. Every task compares at most about ``WIDE`` by
``WIDE`` vectors, ``ROWS`` by ``COLUMNS`` of them at once: large cells, and many queries to one cell,
are spread over more tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from hirelattice.operators.dedup import dedup_rank
from hirelattice.session import cut

# vectors of a block: cut finer than WIDE only down to BLOCK, and only for SPLIT blocks a side, as each block of one side is sent to every block of the other
BLOCK, WIDE, SPLIT = 4096, 32_768, 8
# blocks whose result may hold many pairs a vector
PAIRED = 8192
# scores that are held at once, and those a query's first bound is taken from
ROWS, COLUMNS, FIRST = 256, 4096, 512
# vectors that are held against all pivots at once, and rows of one batch that go back to Spark
AT_ONCE, BATCH = 512, 1 << 14
MAX_PIVOTS = 2048
# up to this size all blocks of the corpus are compared, which is quicker than dividing it
UNDIVIDED = 50_000
# partial sums that are added up in one group
FAN_IN = 16
# slack of the cell bounds, far above the rounding of the distances
SLACK = 1e-5
# scores are ranked as rounded here, so that rounding noise cannot order equal vectors
DIGITS = 9
# components of unit vectors of one direction agree to this many digits, beyond the rounding of the scores
SAME = 12

_VECTOR = "id bigint, vec array<double>"


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64, copy=False) if len(vectors) else np.zeros((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def prepare_vectors(df: DataFrame, unit: bool, side: str = "corpus") -> DataFrame:
    """(id, vec) in doubles; for cosine each vector is scaled to length one.

    Vectors that are null or hold a null or non-finite component are left out: they have no distance to anything. A zero vector has cosine 0 with everything. It becomes a unit vector of its own in one of two
    extra coordinates, one per side, so that the geometry used for pruning holds for it too.
    """
    finite = F.forall("vec", lambda x: F.coalesce((F.abs(x) != float("inf")) & ~F.isnan(x), F.lit(False)))
    rows = df.filter("vec is not null").filter(finite).select(F.col("id").cast("bigint").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    if not unit:
        return rows

    def scale(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                m = _matrix(pdf["vec"])
                norm = np.sqrt((m * m).sum(1, keepdims=True))
                zero = (norm == 0.0).astype(np.float64)
                extra = [zero, 0 * zero] if side == "corpus" else [0 * zero, zero]
                pdf["vec"] = list(np.hstack([m / (norm + zero), *extra]))
            yield pdf

    return rows.mapInPandas(scale, _VECTOR)


@dataclass(frozen=True)
class Cells:
    """A corpus divided around pivots, with the size and radius of each cell; one cell has no pivot."""

    rows: DataFrame
    pivots: np.ndarray | None
    counts: np.ndarray
    radius: np.ndarray


def _slices(pdf: pd.DataFrame, n: int) -> Iterator[pd.DataFrame]:
    return (pdf.iloc[low:low + n] for low in range(0, len(pdf), n))


def undivided(corpus: DataFrame, n: float) -> Cells:
    return Cells(corpus.withColumn("cell", F.lit(0)), None, np.array([float(n)]), np.array([np.inf]))


def divide(corpus: DataFrame, n_pivots: int | None = None, approx: bool = False) -> Cells:
    """Assign every vector to its nearest pivot; a small corpus stays one cell of several blocks.

    An approximate search divides a corpus of any size, so that its answer depends on its arguments alone.

    Pivots are rows picked by a hash of the id, at most ``MAX_PIVOTS``; with them, the counts and the
    radii, the driver holds a bounded number of vectors.
    """
    spark = corpus.sparkSession
    n = corpus.count()
    if n_pivots is None:
        n_pivots = 1 if n <= UNDIVIDED and not approx else min(MAX_PIVOTS, math.ceil(math.sqrt(n)))
    if n_pivots > MAX_PIVOTS:
        raise ValueError(f"at most {MAX_PIVOTS} pivots: the driver holds them")
    if n_pivots <= 1 or n <= 1:
        return undivided(corpus, n)
    picked = corpus.orderBy(F.xxhash64("id"), "id").limit(n_pivots).collect()
    pivots = np.array([r["vec"] for r in picked], dtype=np.float64)
    shared = spark.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in _slices(pdf, AT_ONCE):
                d = _distances(_matrix(part["vec"]), shared.value)
                yield part.assign(cell=d.argmin(1).astype(np.int32), away=d.min(1))

    rows = corpus.mapInPandas(assign, _VECTOR + ", cell int, away double")
    counts, radius = np.zeros(len(pivots)), np.zeros(len(pivots))
    for r in rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect():
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
    return Cells(rows.drop("away"), pivots, counts, radius)


def _chosen(batches: Iterator[pd.DataFrame], found, choose) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Some queries at a time and the mask of the cells they open."""
    pivots, counts, radius = found
    for pdf in batches:
        for part in _slices(pdf, AT_ONCE):
            d = _distances(_matrix(part["vec"]), pivots)
            yield part, choose(d, counts, radius, part) & (counts > 0)[None, :]


def _probes(queries: DataFrame, cells: Cells, choose) -> DataFrame:
    """(id, vec, cell) for the cells ``choose(pivot distances, batch)`` opens, given as a mask."""
    if cells.pivots is None:
        return queries.select("id", "vec", F.lit(0).alias("cell"))
    shared = queries.sparkSession.sparkContext.broadcast((cells.pivots, cells.counts, cells.radius))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, mask in _chosen(batches, shared.value, choose):
            row, cell = np.nonzero(mask)
            for low in range(0, len(row), BATCH):
                out = pdf.iloc[row[low:low + BATCH]][["id", "vec"]].reset_index(drop=True)
                out["cell"] = cell[low:low + BATCH].astype(np.int32)
                yield out

    return queries.mapInPandas(pick, _VECTOR + ", cell int")


def _cells_pay(queries: DataFrame, cells: Cells, choose) -> bool:
    """Whether opening the cells that ``choose`` names moves no more rows than comparing all blocks does."""
    shared = queries.sparkSession.sparkContext.broadcast((cells.pivots, cells.counts, cells.radius))

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, mask in _chosen(batches, shared.value, choose):
            yield pd.DataFrame({"asked": [len(pdf)], "opened": [int(mask.sum())]})

    sums = queries.mapInPandas(tally, "asked bigint, opened bigint").agg(
        F.coalesce(F.sum("asked"), F.lit(0)).alias("asked"), F.coalesce(F.sum("opened"), F.lit(0)).alias("opened"))
    n = F.lit(float(cells.counts.sum()))
    # the corpus moves at least once in either case
    return sums.select(F.col("opened") + n <= F.col("asked") * blocks(n) + n * blocks(F.col("asked"))).first()[0]


def _compare(probes: DataFrame, cells: Cells, work, schema: str) -> DataFrame:
    """Run ``work(query ids, query matrix, corpus ids, corpus matrix)`` on blocks of opened cells."""
    if cells.pivots is None:
        many = blocks(probes.agg(F.count("*")).scalar())
        left, right = (df.withColumns({"cs": blocks(F.lit(float(cells.counts[0]))), "qs": many}) for df in (probes, cells.rows))
    else:
        loads = probes.groupBy("cell").agg(F.count("*").alias("nq"))
        sizes = probes.sparkSession.createDataFrame(
            [(i, int(n)) for i, n in enumerate(cells.counts) if n > 0], "cell int, nc long")
        # one row per cell, at most MAX_PIVOTS
        split = math.ceil(SPLIT / math.sqrt(max(1, int((cells.counts > 0).sum()))))
        plan = F.broadcast(sizes.join(loads, "cell").select("cell", blocks(F.col("nc"), split).alias("cs"), blocks(F.col("nq"), split).alias("qs")))
        left, right = probes.join(plan, "cell"), cells.rows.join(plan, "cell")
    return compare_blocks(left, right, work, schema)


def blocks(n, split: int | None = None):
    """How many blocks a cell with ``n`` rows on one side is cut into: of ``WIDE`` rows, or smaller ones down to ``BLOCK`` for ``split`` of them."""
    return F.greatest(F.ceil(n / max(BLOCK, WIDE)), F.least(F.ceil(n / BLOCK), F.lit(split or SPLIT)), F.lit(1)).cast("int")


def compare_blocks(left: DataFrame, right: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on (id, vec, cell, qs, cs) of both sides, each cell cut into ``qs`` by ``cs`` pairs of blocks."""
    part = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = left.select("cell", part(F.col("qs")).alias("q"), spread(F.col("cs")).alias("c"), "id", "vec")
    right = right.select("cell", spread(F.col("qs")).alias("q"), part(F.col("cs")).alias("c"), "id", "vec")
    return meet(left, right, work, schema)


def meet(left: DataFrame, right: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on (cell, q, c, id, vec) of both sides, one pair of blocks at a time."""
    names = [f.split()[0] for f in schema.split(", ")]

    def block(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({n: [] for n in names})
        return work(a["id"].to_numpy(), _matrix(a["vec"]), b["id"].to_numpy(), _matrix(b["vec"]))

    keys = ["cell", "q", "c"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(block, schema)


def _tiles(m: int, n: int) -> Iterator[tuple[slice, slice]]:
    """``m`` by ``n`` scores, some at a time; all rows of some columns come before the next columns."""
    low = 0
    while low < n:
        high = min(n, low + (COLUMNS if low else FIRST))
        for r in range(0, m, ROWS):
            yield slice(r, min(m, r + ROWS)), slice(low, high)
        low = high


def _where(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true places, much faster than numpy's own search in two dimensions."""
    return np.divmod(np.flatnonzero(mask.ravel()), mask.shape[1])


def top_of_block(k: int, cosine: bool):
    half = 0.4 * 10.0 ** -DIGITS

    def work(qid, q, cid, c):
        # in order of the ids, so that of equal scores those found first stay
        order = np.argsort(cid, kind="stable")
        n = min(k, len(cid))
        scores, places = np.full((len(qid), n), -np.inf), np.zeros((len(qid), n), dtype=np.int64)
        columns = None
        for rows, at in _tiles(len(qid), len(cid)):
            if columns != at:
                columns, some = at, c[order[at]]
            near = q[rows] @ some.T if cosine else -_distances(q[rows], some)
            worst = scores[rows, -1]
            least = worst + half
            if np.isinf(worst).any():
                kept = min(n, near.shape[1])
                least = np.where(np.isinf(worst), np.partition(near, -kept, axis=1)[:, -kept] - 2 * half, least) if kept == n else np.full(len(worst), -np.inf)
            row, col = _where(near >= least[:, None])
            if not len(row):
                continue
            held = np.unique(row)
            who = np.concatenate([np.repeat(held, n), row])
            score = np.concatenate([scores[rows][held].ravel(), np.round(near[row, col], DIGITS)])
            place = np.concatenate([places[rows][held].ravel(), col + at.start])
            best = np.lexsort((place, -score, who))
            who = who[best]
            first = np.searchsorted(who, held)
            # every row holds n already, if only empty ones
            take = best[(first[:, None] + np.arange(n)).ravel()]
            scores[rows.start + held], places[rows.start + held] = score[take].reshape(-1, n), place[take].reshape(-1, n)
        return pd.DataFrame({"query_id": np.repeat(qid, n), "offer_id": cid[order[places.ravel()]], "score": scores.ravel()})

    return work


HITS = "query_id bigint, offer_id bigint, score double"


def first_k(hits: DataFrame, k: int) -> DataFrame:
    return dedup_rank(hits, ["query_id"], [F.col("score").desc(), F.col("offer_id").asc()], keep=k, rank="rank")


def _nearest_cells(k: int, at_least: int):
    """As many of the nearest cells as it takes to hold ``k`` vectors, and no fewer than asked for."""

    def choose(d, counts, radius, pdf):
        order = np.argsort(d, axis=1, kind="stable")
        filled = counts[order] > 0
        held = np.cumsum(counts[order], axis=1) - counts[order]
        seen = np.cumsum(filled, axis=1) - filled
        mask = np.zeros_like(d, dtype=bool)
        np.put_along_axis(mask, order, (held < k) | (seen < at_least), axis=1)
        return mask

    return choose


def _search(queries: DataFrame, corpus: DataFrame, k: int, cosine: bool, approx_cells: int | None, n_pivots: int | None) -> DataFrame:
    cells = divide(corpus, n_pivots, bool(approx_cells))
    top = top_of_block(k, cosine)
    nearest = _nearest_cells(k, approx_cells or 1)
    first = first_k(_compare(_probes(queries, cells, nearest), cells, top, HITS), k)
    if cells.pivots is None or approx_cells:
        return first
    # these rows give the bound and part of the result, and must be the same rows in both
    first = cut(first)
    worst = first.groupBy("query_id").agg(F.min("score").alias("worst"))
    bound = F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) - 2 * F.col("worst"))) if cosine else -F.col("worst")
    bounded = queries.join(worst, queries["id"] == worst["query_id"]).select("id", "vec", bound.alias("bound"))

    def reachable(d, counts, radius, pdf):
        near = d - radius[None, :] <= pdf["bound"].to_numpy()[:, None] + SLACK
        return near & ~nearest(d, counts, radius, pdf)

    if n_pivots is None and not _cells_pay(bounded, cells, reachable):
        return first_k(_compare(queries.withColumn("cell", F.lit(0)), undivided(corpus, cells.counts.sum()), top, HITS), k)
    second = _compare(_probes(bounded, cells, reachable), cells, top, HITS)
    return first_k(first.select("query_id", "offer_id", "score").unionByName(second), k)


def distinct_queries(asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each distinct query vector under its lowest id, and (member, query_id) for all queries."""
    groups = asked.groupBy("vec").agg(F.min("id").alias("id"))
    # the digest as a further key makes Spark deal out both sides anew, so that it can split a vector many queries share
    digest = F.xxhash64("vec").alias("digest")
    members = asked.select(F.col("id").alias("member"), "vec", digest).join(
        groups.select(F.col("id").alias("query_id"), "vec", digest), ["digest", "vec"])
    return groups.select("id", "vec"), members.select("member", "query_id")


def knn(
    queries: DataFrame, corpus: DataFrame, k: int, metric: str = "cosine", threshold: float | None = None,
    exclude_self: bool = False, approx_cells: int | None = None, n_pivots: int | None = None,
) -> DataFrame:
    """(query_id, rank, offer_id, similarity or distance): the ``k`` nearest of ``corpus`` per query.

    Both sides are (id, vec). Ties, after rounding to nine digits, fall to the lowest id. ``threshold``
    sets smaller similarities to 0. ``exclude_self`` leaves out the offer with the query's own id.
    ``approx_cells`` opens only that many cells per query and so may miss neighbours.

    Copies are dealt with before anything is compared: of equal vectors only the lowest ids can be
    among anyone's nearest, and equal queries have equal answers.
    """
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    cosine = metric == "cosine"
    depth = k + 1 if exclude_self else k
    offers = cut(dedup_rank(prepare_vectors(corpus, cosine), ["vec"], ["id"], keep=depth))
    distinct, members = distinct_queries(cut(prepare_vectors(queries, cosine, "query")))
    found = _search(distinct, offers, depth, cosine, approx_cells, n_pivots).drop("rank")
    hits = members.join(found, "query_id").select(F.col("member").alias("query_id"), "offer_id", "score")
    if exclude_self:
        hits = hits.filter("query_id <> offer_id")
    hits = first_k(hits, k)
    if not cosine:
        return hits.select("query_id", "rank", "offer_id", (-F.col("score")).alias("distance"))
    similarity = F.col("score")
    if threshold is not None:
        similarity = F.when(similarity >= threshold, similarity).otherwise(F.lit(0.0))
    return hits.select("query_id", "rank", "offer_id", similarity.alias("similarity"))


def best_match(queries: DataFrame, corpus: DataFrame, **options) -> DataFrame:
    """(query_id, offer_id, similarity) of the best offer only."""
    return knn(queries, corpus, 1, **options).drop("rank")


def _directions(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unit vectors by direction: the lowest id of each class, and (member, id) of all rows.

    Vectors are of one direction if their components agree to ``SAME`` digits. A zero vector has none: it is a class of its own.
    """
    key = F.sha2(F.array_join(F.transform("vec", lambda x: F.format_string(f"%.{SAME}f", F.round(x, SAME) + F.lit(0.0))), ","), 256)
    dimension = F.size("vec") - 2
    zero = (F.element_at("vec", dimension + 1) > 0) | (F.element_at("vec", dimension + 2) > 0)
    keyed = rows.withColumn("_key", F.when(zero, F.concat(F.lit("0:"), F.col("id").cast("string"))).otherwise(key))
    least = keyed.groupBy("_key").agg(F.min(F.struct("id", "vec")).alias("_l"))
    # the second key makes Spark deal out both sides anew, so that it can split a direction of many rows
    again = lambda df: df.withColumn("_again", F.xxhash64("_key"))
    members = again(keyed.select(F.col("id").alias("member"), "_key")).join(again(least.select("_key", F.col("_l.id").alias("id"))), ["_key", "_again"])
    # zero vectors take part in no pair
    return least.filter(~F.startswith("_key", F.lit("0:"))).select("_l.id", "_l.vec"), members.select("member", "id")


def near_pairs(corpus: DataFrame, threshold: float, n_pivots: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, other, similarity) of all pairs with a cosine of ``threshold`` or more, and (member, id) of all rows with a vector.

    Vectors of one direction are one class under their lowest id, so a group of copies, scaled or not, costs as many rows
    as it has members; pairs are of classes, ``id`` below ``other``. Cells wholly out of reach are not opened.
    Vectors that are null or hold a null or non-finite component are left out; a zero vector has no pair.
    """
    classes, members = _directions(cut(prepare_vectors(corpus, True)))
    rows = cut(classes)
    cells = divide(rows, n_pivots)
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))

    def reachable(d, counts, radius, pdf):
        return d - radius[None, :] <= reach + SLACK

    def over(qid, q, cid, c, halved=False):
        # two blocks meet once if halved, and hold no id in common unless they are the same
        swapped = halved and not np.isin(qid[:1], cid).any()
        found = []
        for a, b in _tiles(len(qid), len(cid)):
            scores = q[a] @ c[b].T
            i, j = _where(scores >= threshold - 10.0 ** -DIGITS)
            one, two, score = qid[a][i], cid[b][j], np.round(scores[i, j], DIGITS)
            keep = (score >= threshold) & ((one < two) | swapped)
            one, two = one[keep], two[keep]
            found.append((np.minimum(one, two), np.maximum(one, two), score[keep]))
        return pd.DataFrame({name: np.concatenate(x) for name, x in zip(("id", "other", "similarity"), zip(*found))})

    # the same rows under column names of their own, as both sides meet in one plan
    asked = rows.select(F.col("id").alias("id"), F.col("vec").alias("vec"))
    schema = "id bigint, other bigint, similarity double"
    if cells.pivots is None or n_pivots is None and not _cells_pay(asked, cells, reachable):
        # the lower block of each two is sent to the higher
        n = F.lit(max(1, math.ceil(cells.counts.sum() / min(PAIRED, BLOCK if cells.counts.sum() <= BLOCK * SPLIT else PAIRED))))
        part = F.pmod(F.xxhash64("id"), n).cast("int")
        left = asked.select(F.lit(0).alias("cell"), part.alias("q"), F.explode(F.sequence(part, n - 1)).alias("c"), "id", "vec")
        right = rows.select(F.lit(0).alias("cell"), F.explode(F.sequence(F.lit(0), part)).alias("q"), part.alias("c"), "id", "vec")
        return meet(left, right, partial(over, halved=True), schema), members
    return _compare(_probes(asked, cells, reachable), cells, over, schema), members


def count_above(queries: DataFrame, corpus: DataFrame, threshold: float, n_pivots: int | None = None) -> DataFrame:
    """(query_id, n): offers with a cosine strictly above the threshold.

    Cells wholly inside the radius are counted without being opened, cells wholly outside not at all.
    """
    offers = cut(prepare_vectors(corpus, True))
    cells = divide(offers, n_pivots)
    distinct, members = distinct_queries(prepare_vectors(queries, True, "query"))
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))

    def inside(d, radius):
        return d + radius[None, :] < reach - SLACK

    def crossing(d, counts, radius, pdf):
        return (d - radius[None, :] <= reach + SLACK) & ~inside(d, radius)

    def tally(qid, q, cid, c):
        n = np.zeros(len(qid), dtype=np.int64)
        for a, b in _tiles(len(qid), len(cid)):
            n[a] += (q[a] @ c[b].T > threshold).sum(1)
        return pd.DataFrame({"query_id": qid, "n": n})

    schema = "query_id bigint, n bigint"
    if cells.pivots is not None and n_pivots is None:
        distinct = cut(distinct)
        if not _cells_pay(distinct, cells, crossing):
            cells = undivided(offers, cells.counts.sum())
    counts = _compare(_probes(distinct, cells, crossing), cells, tally, schema)
    if cells.pivots is not None:
        shared = queries.sparkSession.sparkContext.broadcast((cells.pivots, cells.counts, cells.radius))

        def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pivots, sizes, radius = shared.value
            for pdf in batches:
                for part in _slices(pdf, AT_ONCE):
                    mask = inside(_distances(_matrix(part["vec"]), pivots), radius)
                    yield pd.DataFrame({"query_id": part["id"], "n": (mask * sizes[None, :]).sum(1).astype(np.int64)})

        counts = counts.unionByName(distinct.mapInPandas(whole, schema))
    totals = counts.groupBy("query_id").agg(F.sum("n").alias("n"))
    return members.join(totals, "query_id", "left").select(
        F.col("member").alias("query_id"), F.coalesce("n", F.lit(0)).alias("n"))


def moments(corpus: DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
    """(count, sum of vectors, sum of outer products): a size set by the dimension, not by the rows.

    Each partition gives one row; at most ``FAN_IN`` rows are added up in one group, over as many levels as that takes.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total = None
        for pdf in batches:
            if len(pdf):
                m = _matrix(pdf["vec"])
                flat = np.concatenate([[len(m)], m.sum(0), (m.T @ m).ravel()])
                total = flat if total is None else total + flat
        if total is not None:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "flat": [total]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "flat": [_matrix(pdf["flat"]).sum(0)]})

    # stored, as the number of partial sums decides how many levels add them up
    sums = cut(corpus.mapInPandas(partial, "part int, flat array<double>"))
    left = (sums.agg(F.max("part")).first()[0] or 0) + 1
    while left > 1:
        left = -(-left // FAN_IN)
        sums = sums.withColumn("part", F.col("part") % left).groupBy("part").applyInPandas(add, "part int, flat array<double>")
    flat = np.array(sums.first()["flat"])
    dim = int((math.isqrt(1 + 4 * (len(flat) - 1)) - 1) // 2)
    return flat[0], flat[1: dim + 1], flat[dim + 1:].reshape(dim, dim)


def similarity_stats(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """(query_id, mean, std, best): row statistics of the similarity matrix, which is never built.

    Mean and spread of a query's cosines follow from the corpus' sum and second moments; the best
    cosine is its nearest neighbour's.
    """
    n, total, outer = moments(prepare_vectors(corpus, True))
    shared = queries.sparkSession.sparkContext.broadcast((total / n, outer / n))

    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mean, second = shared.value
        for pdf in batches:
            if len(pdf):
                q = _matrix(pdf["vec"])
                mu = q @ mean
                spread = np.sqrt(np.maximum(((q @ second) * q).sum(1) - mu * mu, 0.0))
                yield pd.DataFrame({"query_id": pdf["id"], "mean": mu, "std": spread})

    rows = prepare_vectors(queries, True, "query").mapInPandas(stats, "query_id bigint, mean double, std double")
    best = best_match(queries, corpus).select("query_id", F.col("similarity").alias("best"))
    return rows.join(best, "query_id")
