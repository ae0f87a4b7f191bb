"""Approximate nearest neighbours by cosine: hyperplane hash tables with multi-probe, planned for a wanted recall.

Each of several tables cuts the space with random hyperplanes; a vector's bucket is the side it lies on of each. A query
opens its own bucket and, in order of how close it lies to the planes between, the next ones (up to ``MAX_FLIPS`` planes away).
How many planes, tables and buckets that takes depends on how near the neighbours are, which is read off the data:
the exact neighbours of a bounded sample of queries are found first, and the cheapest plan under which they would be
opened as often as wanted, plus twice the standard error of the sample, is taken. No query opens more than half the
buckets of a table, nor all tables together more than ``MOST`` of the corpus, so it is never compared as a whole.

Vectors are compared block by block as in the exact search. Buckets that hold many rows, and those that many queries
open, are cut into blocks; of equal vectors only the lowest ids are kept and equal queries are answered once.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from hirelattice.operators import similarity as sim
from hirelattice.operators.dedup import dedup_rank
from hirelattice.session import broadcast_if_small, cut

# queries whose exact neighbours the plan is fitted on
SAMPLE = 256
MAX_TABLES = 32
MAX_PROBES = 64
MAX_FLIPS = 2
# moving one vector to one more bucket, through the shuffle and its sort, costs about as much as comparing so many pairs
COPY = 500
# no plan may compare a query with more of the corpus than that
MOST = 0.75
# rows of one batch that go back to Spark
BATCH = 1 << 14
SEED = 20240229


@dataclass(frozen=True)
class Plan:
    """``tables`` of 2**``bits`` buckets, of which a query opens ``probes`` each; ``recall`` is that of the sample."""

    bits: int
    tables: int
    probes: int
    recall: float

    @property
    def share(self) -> float:
        """The share of the corpus a query would be compared with if buckets were equal and tables independent."""
        return 1.0 - (1.0 - self.probes / 2 ** self.bits) ** self.tables

    def planes(self, dim: int) -> np.ndarray:
        return planes(dim, self.tables, self.bits)


def planes(dim: int, tables: int, bits: int) -> np.ndarray:
    """(table, bit, dim); the first tables are the same whatever their number."""
    return np.stack([np.random.default_rng([SEED, bits, t]).normal(size=(bits, dim)) for t in range(tables)])


def flips(bits: int) -> np.ndarray:
    """All ways to change up to ``MAX_FLIPS`` bits, as rows of 0 and 1; the first changes none."""
    sets = [s for n in range(min(MAX_FLIPS, bits) + 1) for s in itertools.combinations(range(bits), n)]
    out = np.zeros((len(sets), bits))
    for row, chosen in zip(out, sets):
        row[list(chosen)] = 1
    return out


def sides(vectors: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Signed distances (vector, table, bit) from the planes."""
    return np.einsum("nd,tbd->ntb", vectors, normals, optimize=True)


def codes(away: np.ndarray) -> np.ndarray:
    return ((away >= 0) << np.arange(away.shape[-1])).sum(-1)


def probe_codes(away: np.ndarray, probes: int) -> np.ndarray:
    """(vector, table, probe): the buckets a query opens, its own first, then by the squared distance to the planes crossed."""
    changes = flips(away.shape[-1])
    cost = (away * away) @ changes.T
    best = np.argsort(cost, axis=-1, kind="stable")[..., :probes]
    mask = (changes.astype(np.int64) << np.arange(away.shape[-1])).sum(-1)
    return codes(away)[..., None] ^ mask[best]


def plan(queries: np.ndarray, neighbours: np.ndarray, sampled: int, n: int, n_queries: int, recall: float) -> Plan:
    """The cheapest plan for ``n_queries`` over ``n`` rows that finds the share ``recall`` of these pairs, row by row.

    ``sampled`` is the number of different queries among the pairs; the sample's standard error follows from it.
    """
    wanted = min(0.999, recall + 2 * math.sqrt(recall * (1 - recall) / max(1, sampled)))
    size = max(2, int(math.log2(max(4, n))))
    options = []
    for bits in range(2, max(3, size - 2) + 1):
        normals = planes(queries.shape[1], MAX_TABLES, bits)
        away = sides(queries, normals)
        differ = (away >= 0) != (sides(neighbours, normals) >= 0)
        cost = (away * away) @ flips(bits).T
        # the place of the neighbour's bucket in the order of probes
        own = (away * away * differ).sum(-1)
        place = (cost < own[..., None] - 1e-12).sum(-1)
        place[differ.sum(-1) > MAX_FLIPS] = 1 << 30
        probes = 1
        while probes <= min(MAX_PROBES, 2 ** (bits - 1), cost.shape[-1]):
            found = np.maximum.accumulate(place < probes, axis=1).mean(0)
            enough = np.flatnonzero(found >= wanted)
            option = Plan(bits, int(enough[0]) + 1, probes, float(found[enough[0]])) if len(enough) else None
            if option and option.share <= MOST:
                options.append(option)
            probes *= 2
    if not options:
        raise ValueError(f"no plan reaches a recall of {recall} with {MAX_TABLES} tables and {MOST:.0%} of the corpus; use the exact search")
    # per query: pairs compared, copies of the query, and its part of the copies of the corpus
    return min(options, key=lambda p: p.share * n + COPY * p.tables * (p.probes + n / max(1, n_queries)))


def fit(queries: DataFrame, corpus: DataFrame, k: int, recall: float, exclude_self: bool = False) -> Plan:
    """A plan for prepared unit vectors, from the exact neighbours of the ``SAMPLE`` queries of least hash."""
    few = cut(queries.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(SAMPLE))
    hits = sim.knn(few, corpus, k, exclude_self=exclude_self)
    pairs = hits.join(few.toDF("query_id", "q"), "query_id").join(corpus.toDF("offer_id", "c"), "offer_id").select("query_id", "q", "c").toPandas()
    if not len(pairs):
        return Plan(2, 1, 1, 1.0)
    return plan(np.stack(pairs["q"]), np.stack(pairs["c"]), pairs["query_id"].nunique(), corpus.count(), queries.count(), recall)


_BUCKETS = "id bigint, vec array<double>, cell bigint"


def _hashed(rows: DataFrame, chosen: Plan, probes: int) -> DataFrame:
    """Every vector once for each table and bucket; the cell numbers both."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for low in range(0, len(pdf), max(1, BATCH // (chosen.tables * probes))):
                part = pdf.iloc[low:low + max(1, BATCH // (chosen.tables * probes))]
                vectors = np.stack(part["vec"].to_numpy())
                at = probe_codes(sides(vectors, chosen.planes(vectors.shape[1])), probes)
                at = at + (np.arange(chosen.tables) << chosen.bits)[None, :, None]
                out = part.loc[part.index.repeat(chosen.tables * at.shape[-1]), ["id", "vec"]].reset_index(drop=True)
                out["cell"] = at.reshape(-1)
                yield out

    return rows.mapInPandas(place, _BUCKETS)


def approximate_knn(queries: DataFrame, corpus: DataFrame, k: int, recall: float = 0.9, exclude_self: bool = False, chosen: Plan | None = None) -> DataFrame:
    """(query_id, rank, offer_id, similarity): up to ``k`` near offers of each query, the share ``recall`` of the exact ones expected.

    Both sides are (id, vec). Ties fall to the lowest id, as in ``knn``. Every row is a true pair with its
    true cosine; what may be missing are nearer ones. A ``chosen`` plan saves the search for one.
    """
    depth = k + 1 if exclude_self else k
    # both sides as one kind of unit vector; zero vectors have an angle to nothing and are left out
    unit = lambda df: sim.prepare_vectors(df, True).filter("element_at(vec, -2) = 0").select("id", F.slice("vec", 1, F.size("vec") - 2).alias("vec"))
    offers = cut(dedup_rank(unit(corpus), ["vec"], ["id"], keep=depth))
    distinct, members = sim.distinct_queries(cut(unit(queries)))
    distinct = cut(distinct)
    chosen = chosen or fit(distinct, offers, depth, recall)
    # hashed once to count and once to compare: the vectors' copies are many times the corpus and go through one shuffle only
    right, left = _hashed(offers, chosen, 1), _hashed(distinct, chosen, chosen.probes)
    # one row for each bucket opened; its blocks are as large as a task holds, as a smaller one sends the other side once more
    loads = left.groupBy("cell").agg(sim.blocks(F.count("*"), 1).alias("qs"))
    sizes = broadcast_if_small(cut(right.groupBy("cell").agg(sim.blocks(F.count("*"), 1).alias("cs")).join(loads, "cell")))
    hits = sim.compare_blocks(left.join(sizes, "cell"), right.join(sizes, "cell"), sim.top_of_block(depth, True), sim.HITS)
    hits = hits.groupBy("query_id", "offer_id").agg(F.max("score").alias("score"))
    found = members.join(hits, "query_id").select(F.col("member").alias("query_id"), "offer_id", "score")
    if exclude_self:
        found = found.filter("query_id <> offer_id")
    return sim.first_k(found, k).select("query_id", "rank", "offer_id", F.col("score").alias("similarity"))


def recall_against(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (n_exact, n_found, recall): how many of the exact hits (query_id, offer_id) were found."""
    pairs = found.select("query_id", "offer_id", F.lit(1).alias("hit"))
    joined = exact.select("query_id", "offer_id").join(pairs, ["query_id", "offer_id"], "left")
    return joined.agg(F.count("*").alias("n_exact"), F.count("hit").alias("n_found")).withColumn("recall", F.try_divide(F.col("n_found").cast("double"), F.col("n_exact")))
