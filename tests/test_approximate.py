"""Hash tables for near neighbours: order of probes, the plan, recall, and rows that are true pairs."""

import numpy as np
import pytest

from hirelattice.operators import approximate as ap, similarity as sim


def _frame(spark, vectors):
    return spark.createDataFrame([(i, None if x is None else [float(v) for v in x]) for i, x in enumerate(vectors)], "id long, vec array<double>")


def test_probes_come_in_order_of_distance():
    away = np.random.default_rng(1).normal(size=(20, 3, 6))
    got = ap.probe_codes(away, 10)
    assert (got[:, :, 0] == ap.codes(away)).all()
    for q in range(20):
        for t in range(3):
            costs = []
            for code in got[q, t]:
                crossed = [(code ^ ap.codes(away)[q, t]) >> b & 1 for b in range(6)]
                costs.append(sum(a * a for a, c in zip(away[q, t], crossed) if c))
            assert costs == sorted(costs) and len(set(got[q, t].tolist())) == 10


def test_plan_reaches_the_recall_and_never_opens_most_buckets():
    rng = np.random.default_rng(2)
    queries = rng.normal(size=(400, 16))
    near = queries + 0.3 * rng.normal(size=(400, 16))
    far = queries + 1.5 * rng.normal(size=(400, 16))
    easy, hard = (ap.plan(queries, n, 400, 100_000, 100_000, 0.9) for n in (near, far))
    assert easy.recall >= 0.9 and hard.recall >= 0.9 and easy.share < hard.share
    assert all(p.probes <= 2 ** (p.bits - 1) for p in (easy, hard))
    higher = ap.plan(queries, near, 400, 100_000, 100_000, 0.99)
    assert higher.recall >= 0.99 and higher.share >= easy.share
    # recall as predicted, on pairs that the plan was not fitted on
    other = rng.normal(size=(3000, 16))
    beside = other + 0.3 * rng.normal(size=(3000, 16))
    opened = ap.probe_codes(ap.sides(other, easy.planes(16)), easy.probes)
    lies = ap.codes(ap.sides(beside, easy.planes(16)))
    assert (opened == lies[:, :, None]).any(axis=(1, 2)).mean() >= 0.9


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    v = np.vstack([rng.normal(c, 0.6, (150, 12)) for c in rng.normal(0, 2, (20, 12))])
    v[::4] = v[0]  # a quarter are copies of one vector
    return v


@pytest.mark.parametrize("block", [4096, 50])
def test_recall_against_the_exact_search(spark, clustered, block, monkeypatch):
    monkeypatch.setattr(sim, "BLOCK", block)  # with 50, buckets are cut into blocks
    df = _frame(spark, clustered)
    found = ap.approximate_knn(df, df, 5, exclude_self=True)
    exact = sim.knn(df, df, 5, exclude_self=True)
    measured = ap.recall_against(found, exact).first()
    assert measured["n_exact"] == 5 * len(clustered) and measured["recall"] >= 0.9
    unit = clustered / np.linalg.norm(clustered, axis=1, keepdims=True)
    seen = {}
    for r in found.collect():
        assert r["similarity"] == pytest.approx(float(unit[r["query_id"]] @ unit[r["offer_id"]]), abs=1e-8) and r["query_id"] != r["offer_id"]
        seen.setdefault(r["query_id"], []).append((r["rank"], -r["similarity"], r["offer_id"]))
    for hits in seen.values():
        assert [r for r, *_ in sorted(hits)] == list(range(1, len(hits) + 1))
        assert [h[1:] for h in sorted(hits)] == sorted(h[1:] for h in hits) and len({h[2] for h in hits}) == len(hits)


def test_copies_find_the_lowest_ids(spark, clustered):
    df = _frame(spark, clustered)
    hits = ap.approximate_knn(df.filter("id = 8"), df, 3, chosen=ap.Plan(4, 2, 1, 1.0)).collect()
    assert [(r["rank"], r["offer_id"], r["similarity"]) for r in sorted(hits)] == [(1, 0, 1.0), (2, 4, 1.0), (3, 8, 1.0)]


def test_odd_vectors_and_empty_tables(spark):
    df = _frame(spark, [None, [0, 0], [float("nan"), 1], [float("inf"), 1], [1, 0], [2, 0], [0, 1]])
    hits = ap.approximate_knn(df, df, 2).collect()
    assert {r["query_id"] for r in hits} == {4, 5, 6} and {r["offer_id"] for r in hits} <= {4, 5, 6}
    none = _frame(spark, [])
    assert ap.approximate_knn(none, df, 2).count() == ap.approximate_knn(df, none, 2).count() == 0
    assert ap.recall_against(hits and ap.approximate_knn(none, df, 2), sim.knn(none, df, 2)).first()["recall"] is None


def test_a_plan_moves_few_copies_of_the_vectors():
    # moving a vector costs far more than comparing a pair, so a plan of some hundred buckets a vector is never the cheapest
    rng = np.random.default_rng(0)
    unit = lambda m: m / np.sqrt((m * m).sum(1, keepdims=True))
    base = np.repeat(rng.normal(size=(256, 64)), 5, axis=0)
    near = base + 0.9 * rng.normal(size=base.shape)
    for n, most in ((100_000, 60), (600_000, 120)):
        chosen = ap.plan(unit(base), unit(near), 256, n, n, 0.9)
        assert chosen.recall >= 0.9 and chosen.tables * (chosen.probes + 1) <= most
