"""Block naming, cross-tokenizer alignment and hard negatives against brute force on small tables."""

import collections
import functools
import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from hirelattice.llm import alignment, blocknames, hardneg
from hirelattice.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, row long, name string, block string, links string, level string"
A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def documents():
    draw = random.Random(4)
    long = " ".join(draw.choice(["alpha", "beta", "Gamma", "dé", "x1"]) for _ in range(3000))
    almost = long[:-1] + "!"
    texts = ["", None, "One two", "one TWO", "one two ", "É", "é", long, long.upper(), long, almost, "a" * 5000, "a" * 4999, "a" * 5001, "\x00", "A\x00",
             "<|endoftext|> is text <s> too", "a  b", "a\n  b \n", " ", "x y ", "▁ x", "naïve café 日本語 🙂🙂", "don't stop.Now\tor\r\n never", "z" * 300]
    rows = [(i, t, 1, "n", "b", "l", "v") for i, t in enumerate(texts)]
    return rows + [rows[2], rows[2], (None, "one two", None, None, None, None, None), (None, None, None, None, None, None, None), (-5, "One Two", 1, "", "", "", "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(5)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()


@pytest.mark.parametrize("block", [64, 1024])
def test_block_names(docs, block):
    rows = documents()
    groups = collections.defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[lower(text)].append(doc_id)
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        same = groups[lower(text)]
        keep = max((i for i in same if i is not None), default=None)
        want[doc_id, keep, len(same), hashlib.sha256(lower(text)).hexdigest()] += 1
    got = blocknames.exact_copies(docs, block).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    # a name for each text, a text for each name, and one row of each stays: one with the greatest id
    assert len({(r.level, r.name) for r in got}) == len(groups) == len({(r.level, r.name, r.text_sha256) for r in got})
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept}) and all(r.doc_id == r.keep_id for r in kept)


def test_block_names_are_ranks_and_a_hot_block_is_spread(spark):
    texts = ["hot" * 20] * 4000 + [f"{k:04d}" for k in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    rows = blocknames.identities(docs, 64).collect()
    names = {t: k for k, t in enumerate(sorted(set(texts)))}
    assert all(r.level == 0 and r.name == names[texts[r.doc_id]] for r in rows) and len(rows) == len(texts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tables this small would go to one task
    try:
        ranked = blocknames.named(docs.selectExpr("doc_id as row", "0 as pos", "1 as size", "cast(text as binary) as block"), [], "hot")[1]
        assert blocknames.identities(docs, 16).select("level", "name").distinct().count() == 501
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shares = [r["count"] for r in ranked.groupBy("part").count().collect()]
    assert len(shares) > 4 and max(shares) < 2 * len(texts) / len(shares)


def test_block_names_of_nothing(spark):
    got = blocknames.exact_copies(spark.createDataFrame([], DOCS))
    assert got.columns[:5] == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and got.count() == 0


@functools.cache
def plain_tokenizers():
    import sentencepiece
    import tokenizers

    a, b = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b, alignment.byte_level_entries(A), alignment.piece_entries(b)


def plain_alignment(texts):
    """Whole texts, sets of ends and all pairs of a group, without pieces, numpy or Spark."""
    a, b, bytes_a, bytes_b = plain_tokenizers()
    out, held = [], collections.Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        want = (" " + text).encode() if text else b""
        if b"".join(bytes_a[i] for i in ids_a) != want or b"".join(bytes_b[i] for i in ids_b) != want:
            ids_a, ids_b = [], []
        ends_a, ends_b = (list(itertools.accumulate(len(v[i]) for i in ids)) for v, ids in ((bytes_a, ids_a), (bytes_b, ids_b)))
        groups, low = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(([i for i, e in zip(ids_a, ends_a) if low < e <= end], [i for i, e in zip(ids_b, ends_b) if low < e <= end]))
            low = end
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        held.update(set(links))
        out.append((len(ids_a), len(ids_b), groups, links))
    most = collections.Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    said = ";".join
    return [(n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(said(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups).encode()).hexdigest() if n_a else "")
            for n_a, n_b, groups, links in out]


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 20, 0])
def test_alignment(docs, heavy):
    rows = documents()
    want = collections.Counter((r[0], *w) for r, w in zip(rows, plain_alignment([r[1] for r in rows])))
    got = alignment.align_documents(docs, A, B, heavy)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == want


def test_alignment_of_nothing(spark):
    assert alignment.align_documents(spark.createDataFrame([], DOCS), A, B).count() == 0


_ODD = st.text(alphabet=st.sampled_from(list(" \n\t\r\x0b\x1c\x85\xa0 ▁ab.,'sé9日🙂\x00<|>")), min_size=1, max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(_ODD, min_size=1, max_size=8))
def test_pieces_align_like_whole_texts(texts):
    facts, said, links, times, first = alignment.Aligner.of(A, B).measure(texts)
    for k, want in enumerate(plain_alignment(texts)):
        assert (*facts[k].tolist(), said[k]) == (*want[:4], want[6])
        assert times[first[k]:first[k + 1]].sum() == want[3]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60))), max_size=6))
def test_galloping(lists):
    a, b = ([np.array(sorted(x[k]), np.int64) for x in lists] for k in (0, 1))
    first = [np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64) for side in (a, b)]
    whole = [np.concatenate([np.zeros(0, np.int64), *side]) for side in (a, b)]
    text, i, j = alignment.common_ends(whole[0], first[0], whole[1], first[1])
    assert [(t, whole[0][p]) for t, p in zip(text, i)] == [(t, v) for t, (x, y) in enumerate(lists) for v in sorted(x & y)]
    assert (whole[0][i] == whole[1][j]).all() and all(first[1][t] <= q < first[1][t + 1] for t, q in zip(text, j))


def vectors(n, dim, seed, labels=4, scale=1.0):
    draw = np.random.default_rng(seed)
    centre = draw.normal(size=(labels, dim))
    rows = []
    for i in range(n):
        label = int(draw.integers(labels))
        x = centre[label] * 0.7 + draw.normal(size=dim) * 0.5
        rows.append((i, label, [float(v) * scale for v in x]))
    return rows


def plain_negatives(rows, every=100, positives=5, negatives=10):
    fit = {}
    for vec_id, label, x in rows:
        if vec_id is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        q = [math.floor(256 * v) for v in x]
        fit[vec_id] = min(fit.get(vec_id, (label, q)), (label, q))
    out = set()
    for a, (label, q) in fit.items():
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, other[1])), b, other[0] == label)
                        for b, other in fit.items() if b != a and len(other[1]) == len(q))
        for p, pos, _ in [s for s in scores if s[2]][:positives]:
            inside = [s for s in scores if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            out |= {(a, pos, k + 1, b, -p, -s) for k, (s, b, _) in enumerate(inside)}
    return out


VECTORS = "vec_id long, label int, embedding array<double>, page long, q string, tile string"


def found(spark, rows, **more):
    table = spark.createDataFrame([(*r, 1, "q", "t") for r in rows], VECTORS).repartition(4)
    got = hardneg.hard_negatives(table, **more).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_hard_negatives(spark):
    rows = vectors(900, 6, 1)
    hot = rows[200][2]
    rows += [(1000 + k, k % 3, hot) for k in range(300)]  # one vector, many rows: ties everywhere
    rows += [rows[0], (100, 0, rows[5][2]), (None, 1, hot), (2001, None, hot), (2002, 1, None), (2003, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (2100, 1, [float("nan")] * 6), (2101, 1, [float("inf")] * 6), (2200, 1, [0.0] * 6), (2300, 2, [-v for v in hot]), (2400, 1, [1.0, 2.0]), (2401, 1, [1.0, 1.0]),
             (2402, 2, [0.5, 0.5]), (2500, 1, []), (2501, 1, []), (2502, 2, [])]
    assert found(spark, rows) == plain_negatives(rows)


def test_hard_negatives_over_many_pages(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "SAMPLE", 64)
    monkeypatch.setattr(hardneg, "PART", 7)
    rows = vectors(4000, 3, 2, labels=40)
    want = plain_negatives(rows)
    assert len(want) > 500 and found(spark, rows) == want


def test_hard_negatives_with_scores_beyond_doubles(spark):
    rows = vectors(220, 2, 3, scale=2e6)
    assert found(spark, rows) == plain_negatives(rows)


def test_tree_leaves_boxes_out():
    draw = np.random.default_rng(5)
    centre = draw.normal(size=(64, 8)) * 300
    q = np.floor(np.repeat(centre, 32, axis=0) + draw.normal(size=(2048, 8)))
    tree = hardneg.Tree(np.arange(2048), np.repeat(np.arange(64), 32), q)
    anchor = q[40]
    low, high = tree.boxes.bounds(anchor[None])
    seen = []
    tree.q = type("Seen", (np.ndarray,), {"__getitem__": lambda self, rows: (seen.append(np.size(rows)), np.asarray(self).__getitem__(rows))[1]})(tree.q.shape, buffer=tree.q)
    ids, scores = tree.search(anchor, 40, 1, True, [(-hardneg.FAR, hardneg.FAR)], [-hardneg.FAR], 5, low[0], high[0])[0]
    want = sorted((-int(q[i] @ anchor), i) for i in range(32, 64) if i != 40)[:5]
    assert list(zip((-scores).astype(int).tolist(), ids.tolist())) == want and sum(seen) <= 64


def test_hard_negatives_of_nothing(spark):
    assert hardneg.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    assert found(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == set()
