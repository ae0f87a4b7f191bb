import tracemalloc

import numpy as np
import pandas as pd
import pytest

from conftest import rows
from hirelattice.operators import metrics as m
from hirelattice.operators import similarity as sim
from hirelattice.operators.encoders import HashingEncoder, encode


def _frame(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vec array<double>")


@pytest.fixture(scope="module")
def data():
    """Clustered vectors; a third of all are copies of one, some are zero."""
    rng = np.random.default_rng(1)
    v = np.vstack([rng.normal(c, 0.3, (60, 6)) for c in rng.normal(0, 2, (5, 6))])
    v[::3] = v[0]
    v[[5, 17, 40]] = 0.0
    return v


def _brute(q, c, k, metric, exclude=False):
    unit = lambda a: a / np.where(np.linalg.norm(a, axis=1, keepdims=True) == 0, 1, np.linalg.norm(a, axis=1, keepdims=True))
    s = unit(q) @ unit(c).T if metric == "cosine" else -np.sqrt(((q[:, None] - c[None]) ** 2).sum(2))
    s = np.round(s, 9)
    out = []
    for i, row in enumerate(s):
        order = [j for j in sorted(range(len(c)), key=lambda j: (-row[j], j)) if not (exclude and i == j)][:k]
        out += [(i, r + 1, j) for r, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("pivots", [None, 9])
def test_near_pairs_are_all_pairs_of_classes(spark, data, pivots, monkeypatch):
    monkeypatch.setattr(sim, "BLOCK", 40)
    pairs, members = sim.near_pairs(_frame(spark, data), 0.9, n_pivots=pivots)
    zero = ~data.any(axis=1)
    classes = {tuple(v): i for i, v in reversed(list(enumerate(data.tolist())))}
    assert sorted(rows(members)) == sorted((i, i if zero[i] else classes[tuple(v)]) for i, v in enumerate(data.tolist()))
    unit = data / np.where(np.linalg.norm(data, axis=1, keepdims=True) == 0, 1, np.linalg.norm(data, axis=1, keepdims=True))
    lead = sorted(i for i in classes.values() if not zero[i])
    want = [(i, j) for i in lead for j in lead if i < j and round(float(unit[i] @ unit[j]), 9) >= 0.9]
    assert want and sorted(rows(pairs.select("id", "other"))) == want


@pytest.mark.parametrize("pivots", [None, 8])
def test_near_pairs_of_scaled_copies_and_odd_vectors(spark, data, pivots):
    """Scaled copies are members of one class, not pairs; a NaN among the rows loses none of the others."""
    scaled = [data[1] * s for s in (0.1, 0.3, 1.0, 3.7, 1e6)]
    vectors = [*data[:60], *scaled, [float("nan")] * 6, [0.0] * 6, [0.0] * 6]
    df = _frame(spark, vectors).union(spark.createDataFrame([(900, None)], "id long, vec array<double>"))
    pairs, members = sim.near_pairs(df, 0.9, n_pivots=pivots)
    found = dict(rows(members))
    assert [found[60 + k] for k in range(5)] == [1] * 5
    assert 65 not in found and 900 not in found and found[66] == 66 and found[67] == 67
    clean, _ = sim.near_pairs(_frame(spark, data[:60]), 0.9, n_pivots=pivots)
    assert rows(pairs.select("id", "other")) == rows(clean.select("id", "other")) != []


def test_moments_are_added_up_in_small_groups(spark, data):
    n, total, outer = sim.moments(_frame(spark, data).repartition(45))
    assert n == len(data) and np.allclose(total, data.sum(0)) and np.allclose(outer, data.T @ data)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("pivots", [None, 9])
@pytest.mark.parametrize("exclude", [False, True])
def test_knn_is_exact(spark, data, metric, pivots, exclude, monkeypatch):
    monkeypatch.setattr(sim, "BLOCK", 40)
    df = _frame(spark, data)
    got = sim.knn(df, df, 4, metric, exclude_self=exclude, n_pivots=pivots)
    # rounding noise may order equal euclidean distances of copies, so compare distances there
    if metric == "cosine":
        assert sorted((r["query_id"], r["rank"], r["offer_id"]) for r in got.collect()) == _brute(data, data, 4, metric, exclude)
    else:
        want = {(q, r): np.linalg.norm(data[q] - data[j]) for q, r, j in _brute(data, data, 4, metric, exclude)}
        assert all(abs(x["distance"] - want[(x["query_id"], x["rank"])]) < 1e-6 for x in got.collect())
        assert got.count() == len(want)


def test_approximate_recall(spark, data):
    df = _frame(spark, data)
    exact = {(r[0], r[1]): r[3] for r in sim.knn(df, df, 5).collect()}
    found = sim.knn(df, df, 5, approx_cells=3, n_pivots=12).collect()
    assert len(found) == len(exact)
    assert np.mean([abs(r["similarity"] - exact[(r["query_id"], r["rank"])]) < 1e-9 for r in found]) > 0.9


@pytest.mark.parametrize("pivots", [None, 7])
def test_counts_and_stats(spark, data, pivots, monkeypatch):
    monkeypatch.setattr(sim, "BLOCK", 40)
    df = _frame(spark, data)
    unit = data / np.where(np.linalg.norm(data, axis=1, keepdims=True) == 0, 1, np.linalg.norm(data, axis=1, keepdims=True))
    s = unit @ unit.T
    got = dict(rows(sim.count_above(df, df, 0.55, pivots)))
    assert got == {i: int((row > 0.55).sum()) for i, row in enumerate(s)}
    stats = {r["query_id"]: r for r in sim.similarity_stats(df, df).collect()}
    for i, row in enumerate(s):
        assert stats[i]["mean"] == pytest.approx(row.mean(), abs=1e-9)
        assert stats[i]["std"] == pytest.approx(row.std(), abs=1e-7)
        assert stats[i]["best"] == pytest.approx(row.max(), abs=1e-8)


def test_hit_metrics_by_hand(spark):
    hits = spark.createDataFrame([(1, 1, 10, .9), (1, 2, 11, .2), (2, 1, 10, .3), (2, 2, 12, .1), (3, 1, 13, .8), (3, 2, 14, .7)],
                                 "query_id long, rank long, offer_id long, similarity double")
    got = m.hit_metrics(hits, 0.5).first()
    assert got["recall_at_1"] == pytest.approx(2 / 3) and got["recall_at_k"] == pytest.approx(2 / 3)
    # three hits in three queries, always over five; the query without a hit counts in nDCG, not in MRR
    assert got["precision_at_k"] == pytest.approx(3 / 15) and got["mrr"] == pytest.approx(1.0) and got["ndcg"] == pytest.approx(2 / 3)
    assert m.non_zero_ratio(hits).first()[0] == 1.0


def test_precision_and_ndcg(spark):
    hits = spark.createDataFrame([(1, 1, True, .5), (1, 2, False, 1.0), (1, 3, True, .2)], "query_id long, rank long, relevant boolean, similarity double")
    truth = spark.createDataFrame([(1, 2), (2, 9)], "query_id long, n_true long")
    assert rows(m.precision_at_k(hits, truth, 2)) == [(1, 0.5), (2, 0.0)]
    gains = [2 ** .5 - 1, 1.0, 2 ** .2 - 1]
    dcg = sum(g / np.log2(i + 2) for i, g in enumerate(gains))
    ideal = sum(g / np.log2(i + 2) for i, g in enumerate(sorted(gains, reverse=True)))
    assert m.ndcg_at_k(hits).first()["ndcg"] == pytest.approx(dcg / ideal)


def test_encoder(spark):
    df = spark.createDataFrame([(1, "Python SQL python"), (2, ""), (3, None)], "id long, t string")
    got = {r["id"]: r["vec"] for r in encode(df, "id", "t", HashingEncoder, batch=2).collect()}
    assert sorted(x for x in got[1] if x) == [1.0, 2.0] and not any(got[2]) and not any(got[3])


@pytest.mark.parametrize("cosine", [True, False])
def test_a_block_holds_few_scores_at_once(cosine):
    # 3000 by 6000 vectors, some of them equal: all scores together are 144 MB
    rng = np.random.default_rng(3)
    q, c = rng.normal(size=(3000, 8)), rng.normal(size=(6000, 8))
    c[4000:4100] = c[:100]
    q[:100] = c[:100]
    if cosine:
        q, c = (m / np.sqrt((m * m).sum(1, keepdims=True)) for m in (q, c))
    ids = rng.permutation(6000) + 10
    tracemalloc.start()
    found = sim.top_of_block(7, cosine)(np.arange(3000), q, ids, c)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6
    scores = np.round(q @ c.T if cosine else -sim._distances(q, c), 9)
    for row in range(0, 3000, 37):
        best = np.lexsort((ids, -scores[row]))[:7]
        mine = found[found["query_id"] == row]
        assert mine["offer_id"].tolist() == ids[best].tolist()
        assert np.allclose(mine["score"], scores[row][best], atol=1e-9)


def test_opened_cells_come_in_bounded_batches():
    queries = pd.DataFrame({"id": range(2000), "vec": list(np.ones((2000, 4)))})
    found = (np.ones((50, 4)), np.ones(50), np.ones(50))
    parts = list(sim._chosen(iter([queries]), found, lambda d, counts, radius, pdf: d <= 1))
    assert sum(mask.sum() for _, mask in parts) == 100_000 and max(len(pdf) for pdf, _ in parts) <= sim.AT_ONCE


def test_all_blocks_are_compared_where_cells_rule_out_little(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 12))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, vec array<double>")
    monkeypatch.setattr(sim, "UNDIVIDED", 100)
    assert not sim._cells_pay(df, sim.divide(df), lambda d, counts, radius, pdf: d >= 0)
    unit = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
    scores = np.round(unit @ unit.T, 9)
    want = {(i, int(j)) for i in range(300) for j in np.lexsort((np.arange(300), -scores[i]))[:4]}
    assert {(r["query_id"], r["offer_id"]) for r in sim.knn(df, df, 4).collect()} == want
    pairs, _ = sim.near_pairs(df, 0.4)
    assert sorted((r["id"], r["other"]) for r in pairs.collect()) == [(i, j) for i in range(300) for j in range(i + 1, 300) if scores[i, j] >= 0.4]
    above = {r["query_id"]: r["n"] for r in sim.count_above(df, df, 0.2).collect()}
    assert above == {i: int((unit[i] @ unit.T > 0.2).sum()) for i in range(300)}
