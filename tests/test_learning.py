"""Decomposition, silhouette and the text classifier against plain numpy."""

import re

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hirelattice.operators import decomposition as d, learning as ml
from hirelattice.operators.tfidf import tfidf


def _frame(spark, vectors):
    return spark.createDataFrame([(i, None if x is None else [float(v) for v in x]) for i, x in enumerate(vectors)], "id long, vec array<double>")


def test_truncated_svd_of_dense_rows(spark, monkeypatch):
    monkeypatch.setattr(d, "CHUNK", 50)
    monkeypatch.setattr(d, "FAN_IN", 2)
    rng = np.random.default_rng(1)
    a = rng.normal(size=(400, 30)) @ np.diag(0.7 ** np.arange(30)) + 3.0  # far from centred
    a[a < 2.9] = 0.0
    rows, dim = d.dense_rows(_frame(spark, [*a, None]).repartition(7))
    got = d.truncated_svd(rows, dim, 5)
    _, values, vectors = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(got.values, values[:5], rtol=1e-6)
    assert np.allclose(np.abs(got.vectors.T @ vectors[:5].T), np.eye(5), atol=1e-3)
    moved = {r["id"]: r["vec"] for r in got.transform(rows).collect()}
    new = a @ got.vectors
    assert np.allclose([moved[i] for i in range(400)], new)
    assert np.allclose(got.explained, new.var(axis=0) / a.var(axis=0).sum())
    # a centred decomposition has other values
    assert abs(np.linalg.svd(a - a.mean(axis=0))[1][0] - values[0]) > 1
    whole = d.truncated_svd(rows, dim, 99)
    assert np.allclose(whole.values, values) and abs(whole.explained.sum() - 1) < 1e-9


def test_truncated_svd_of_texts(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(60)]
    texts = [(i, " ".join(rng.choice(words[(i % 3) * 20:(i % 3) * 20 + 25 if i % 3 < 2 else 60], 30))) for i in range(120)]
    weights = tfidf(spark.createDataFrame(texts, "id long, text string").repartition(5), "id", "text")
    rows, dim = d.sparse_rows(weights, "id", "term", "weight")
    terms = sorted({r["term"] for r in weights.collect()})
    assert dim == len(terms)
    a = np.zeros((120, dim))
    for r in weights.collect():
        a[r["id"], terms.index(r["term"])] = r["weight"]
    for r in rows.collect():
        assert r["at"] == np.flatnonzero(a[r["id"]]).tolist() and np.allclose(a[r["id"]][r["at"]], r["value"])
    assert np.allclose(d.truncated_svd(rows, dim, 3).values, np.linalg.svd(a)[1][:3], rtol=1e-5)
    # the same rows where the terms are known, without a pass over the weights to find them
    known = d.sparse_rows(weights, "id", "term", "weight", spark.createDataFrame([(t,) for t in terms], "term string"))
    assert known[1] == dim and sorted(map(tuple, known[0].collect())) == sorted(map(tuple, rows.collect()))


def test_decomposition_of_nothing(spark):
    rows, dim = d.dense_rows(_frame(spark, []))
    assert dim == 0 and len(d.truncated_svd(rows, dim, 3).values) == 0


@pytest.mark.parametrize("block", [2048, 40])
def test_silhouette_by_plain_distance(spark, block, monkeypatch):
    monkeypatch.setattr(d, "BLOCK", block)
    rng = np.random.default_rng(3)
    v = np.vstack([rng.normal(c, 1.0, (40, 4)) for c in rng.normal(0, 2, (3, 4))] + [[[9.0, 9, 9, 9]]])
    of = [k // 40 for k in range(120)] + [7]  # the last row is a cluster of its own
    df = spark.createDataFrame([(i, [float(x) for x in r], of[i]) for i, r in enumerate(v)] + [(500, None, 1), (501, [0.0] * 4, None)], "id long, vec array<double>, cluster int")
    far = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    want = []
    for i in range(121):
        means = {c: far[i, [j for j in range(121) if of[j] == c and j != i]].mean() for c in set(of) if any(of[j] == c and j != i for j in range(121))}
        own = means.pop(of[i], None)
        want.append(0.0 if own is None else (min(means.values()) - own) / max(own, min(means.values())))
    got = {r["id"]: r["silhouette"] for r in d.silhouettes(df).collect()}
    assert sorted(got) == list(range(121)) and np.allclose([got[i] for i in range(121)], want, atol=1e-9)
    row = d.silhouette(df).first()
    assert row["n"] == 121 and row["silhouette"] == pytest.approx(np.mean(want))
    # squared distances would give another number
    assert d.silhouette(df.filter("cluster = 1")).first()["silhouette"] is None


def test_text_classifier_is_the_optimum_over_smoothed_unit_vectors(spark):
    rng = np.random.default_rng(4)
    pool = [f"mot{k}" for k in range(30)]
    rows = [(i, " ".join(rng.choice(pool[(i % 3) * 8:(i % 3) * 8 + 14], 12)), float(i % 3), i % 5 != 0) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, text string, label double, is_train boolean")
    train = ml.with_words(df.filter("is_train"), "text")
    model = ml.text_classifier(train, "label")
    terms = model.stages[0].vocabulary
    # the features, by hand
    counts = np.array([[re.findall(r"\w{2,}", text).count(t) for t in terms] for _, text, _, _ in rows], float)
    learnt = np.array([r[3] for r in rows])
    idf = np.log((1 + learnt.sum()) / (1 + (counts[learnt] > 0).sum(axis=0))) + 1
    x = counts * idf
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {r["id"]: r["v"] for r in model.transform(ml.with_words(df, "text")).select("id", vector_to_array("_features").alias("v")).collect()}
    assert np.allclose([got[i] for i in range(150)], x)
    # softmax of the weights
    w, b = model.stages[-1].coefficientMatrix.toArray(), model.stages[-1].interceptVector.toArray()
    z = x @ w.T + b
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    accuracy, scored = ml.classify_text(df, "text", "label")
    probabilities = {r["id"]: r["probabilities"] for r in scored.collect()}
    assert np.allclose([probabilities[i] for i in range(150)], p, atol=1e-6)
    # no direction improves the sum of losses plus half the squared weights
    y = np.eye(3)[[int(r[2]) for r in rows]]
    slope = (p - y)[learnt].T @ x[learnt] + w
    assert np.abs(slope).max() < 1e-2 and np.abs((p - y)[learnt].sum(axis=0)).max() < 1e-2
    right = p.argmax(axis=1) == y.argmax(axis=1)
    assert {r["split"]: (r["n"], pytest.approx(r["accuracy"])) for r in accuracy.collect()} == {
        "train": (int(learnt.sum()), right[learnt].mean()), "test": (int((~learnt).sum()), right[~learnt].mean())}


def test_silhouette_sends_every_row_to_few_blocks(spark):
    # 20480 rows were cut into ten blocks of 2048, and each row sent to all of them
    df = spark.range(20_480).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vec"), (F.col("id") % 2).alias("cluster"))
    plan = d.silhouettes(df)._jdf.queryExecution().optimizedPlan().toString()
    assert set(re.findall(r"pmod\(xxhash64\([^)]*\), (\d+)\)", plan)) == {str(d.SPLIT)}


def test_a_forest_is_grown_on_partitions_of_bounded_size(spark, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor

    seen, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, rows: seen.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    df = spark.range(0, 400, numPartitions=1).selectExpr("id", "cast(id as double) as x", "cast(id * 2 as double) as y", "id % 4 > 0 as is_train")
    whole = ml.regress_forest(df, ["x"], "y", trees=5, depth=3).first()
    monkeypatch.setattr(ml, "PART", 50)
    parted = ml.regress_forest(df, ["x"], "y", trees=5, depth=3).first()
    assert seen == [1, 8] and whole["n"] == parted["n"] == 100 and parted["r2"] > 0.8


def test_text_classifier_needs_few_passes(spark):
    rng = np.random.default_rng(5)
    weights = 1.0 / np.arange(1, 3001) ** 0.8
    rows = []
    for i in range(600):
        # kinds of texts apart from the label, and many words that one text alone has
        pool = (rng.choice(3000, 60, p=weights / weights.sum()) + 500 * (i % 5)) % 3000
        rows.append((" ".join([f"w{k}" for k in pool] + [f"only{i}x{k}" for k in range(20)]), float(rng.random() < 0.2 + 0.6 * (i % 2)) * 2))
    train = ml.with_words(spark.createDataFrame(rows, "text string, label double").repartition(4), "text").cache()
    spark.sparkContext.setJobGroup("few passes", "")
    model = ml.text_classifier(train, "label")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few passes")) < 90
    # class 1 has no rows, yet has weights as the others; the slope is that of the optimum
    x = np.array([r["v"] for r in model.transform(train).select(vector_to_array("_features").alias("v")).collect()])
    y = np.eye(3)[[int(r["label"]) for r in train.select("label").collect()]]
    p = np.array([r["p"] for r in model.transform(train).select(vector_to_array("probability").alias("p")).collect()])
    w = model.stages[-1].coefficientMatrix.toArray()
    assert w.shape == (3, len(model.stages[0].vocabulary)) and np.abs(w.sum(axis=0)).max() < 1e-9 and p[:, 1].max() < 1e-3
    assert np.abs((p - y).T @ x + w).max() < 1e-2 and np.abs((p - y).sum(axis=0)).max() < 1e-2
    # nothing to tell apart, as before
    same = ml.text_classifier(train.filter("label = 2"), "label")
    assert {r["prediction"] for r in same.transform(train.filter("label = 2")).collect()} == {2.0}
    train.unpersist()
