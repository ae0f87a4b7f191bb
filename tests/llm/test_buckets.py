"""Members of a bucket of near copies, compared block by block."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from hirelattice.llm import minhash


def _edited(n: int, rng: random.Random) -> list[str]:
    base = [f"w{i}" for i in range(80)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randint(0, 3)):
            words[at] = f"x{rng.randint(0, 9999)}"
        out.append(" ".join(words))
    return out


def _set(text: str) -> set:
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_linked_is_the_exact_jaccard_of_full_sets(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = random.Random(3)
    sets = [sorted(rng.sample(range(40), rng.randint(20, 40))) for _ in range(30)] + [[99]]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    got = minhash.linked(np.concatenate([np.array(s) for s in sets]), first)
    np.fill_diagonal(got, True)  # a set is not asked about itself
    want = [[100 * len(set(a) & set(b)) >= 75 * len(set(a) | set(b)) for b in sets] for a in sets]
    assert got.tolist() == want


def test_a_group_of_near_copies_gives_no_more_links_than_members(spark, monkeypatch):
    monkeypatch.setattr(minhash, "MEMBERS", 8)
    texts = _edited(60, random.Random(5))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    component = list(range(len(texts)))
    sets = [_set(t) for t in texts]
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and component[a] != component[b]:
                low, high = sorted((component[a], component[b]))
                component = [low if c == high else c for c in component]
    assert got == dict(enumerate(component))
    hashes = [np.unique([hash(s) for s in x]) for x in sets]
    members = pa.table({"node": list(range(60)), "component": list(range(60)), "items": pa.array([h.tolist() for h in hashes], pa.list_(pa.int64()))})
    links = minhash._forest(members)
    near = minhash.linked(np.concatenate(hashes), np.concatenate([[0], np.cumsum([len(h) for h in hashes])]))
    assert links.num_rows < 60 < near.sum() // 2


def test_buckets_with_one_more_copy_of_an_id_are_not_taken_for_one_another(spark):
    # two sets under one id come as two rows of a bucket
    text = "a b c d e f g"
    sketch = next(minhash._sketch(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})])))
    k1, k2 = (sketch.column(c)[0].as_py() for c in ("k1", "k2"))
    docs = spark.createDataFrame([(i, text) for i in (1, 2, 3, 4)], "doc_id long, text string")
    nodes = spark.createDataFrame([(i, k1, k2, 3) for i in (1, 2, 3, 4)], "node long, k1 long, k2 long, n long")
    placed = spark.createDataFrame([(7, 1, 1), (7, 1, 1), (7, 2, 2), (7, 3, 3), (8, 4, 4), (8, 4, 4), (8, 2, 2), (8, 3, 3)], "band long, node long, component long")
    links = {tuple(sorted(r)) for r in minhash._links_between(docs, nodes, placed).collect()}
    assert {n for pair in links for n in pair} == {1, 2, 3, 4}
