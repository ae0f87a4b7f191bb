"""Each operator against brute force on small tables, with nulls, empty and long texts, ties, copies and empty tables."""

import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from hirelattice.llm import covertree, decontaminate, huffman, minhash, packing, passages, quality, queries, rollup, sharding, urlfilter
from hirelattice.llm.common import connected_components
from hirelattice.session import run_dir

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, size string, shift string, __doc string"
WORDS = [f"w{i}" for i in range(400)]


def prose(n, seed, pool=WORDS):
    draw = random.Random(seed)
    return " ".join(draw.choice(pool) for _ in range(n))


def documents():
    base, passage = prose(120, 1), prose(60, 2)
    near = base.split()
    near[50] = "changed"
    texts = [
        base, base, base, " ".join(near), base.upper(), "", None, "one", "one", "one two three", "\t \n", "\x00",
        prose(3000, 3), f"{prose(80, 4)} {passage} {prose(70, 5)}", f"{prose(30, 6)} {passage} {prose(90, 7)}", passage,
        "to " * 300, prose(20, 8), "é ü ß 中文 words here now", "<|endoftext|> is text", "x" * 5000]
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "a", "b", "c", "d") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingle_set(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def group(ids, linked):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_shards(docs, none):
    rows = sharding.shard_documents(docs, 4).collect()
    assert len(rows) == len(documents())
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for held in by.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    sizes = [sum(r["size"] for r in by.get(k, [])) for k in range(4)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in documents())
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == want
    assert sharding.shard_documents(none, 4).count() == 0


def test_copies_are_split_over_shards(spark):
    rows = sharding.shard_documents(spark.range(4000).selectExpr("cast(1 as long) as doc_id", "'same text' as text"), 8).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in rows) == [500] * 8


def test_minhash(docs, none):
    rows = minhash.near_duplicates(docs).collect()
    sets = {i: shingle_set(t) for i, t, *_ in documents() if i is not None}
    near = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    want = group(sets, near)
    assert len(rows) == len(documents())
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    assert minhash.near_duplicates(none).count() == 0


def test_minhash_finds_links_that_the_star_misses(spark):
    """A chain of edits: neighbours are alike, the ends are not."""
    chain, text = [], prose(60, 9).split()
    for k in range(12):
        chain.append((k, " ".join(text)))
        text[5 * k] = f"edit{k}"
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string")).collect()}
    sets = {i: shingle_set(t) for i, t in chain}
    assert got == group(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))


def test_passages(docs, none):
    out = {r["doc_id"]: r["text"] for r in passages.remove_repeats(docs).collect() if r["doc_id"] is not None}
    texts = {i: t for i, t, *_ in documents() if i is not None}
    passage = prose(60, 2)
    assert [i for i, t in out.items() if passage in (t or "")] == [13]
    assert out[14] == f"{prose(30, 6)} {prose(90, 7)}" and out[15] == ""
    for i in (5, 6, 7, 9, 12, 16, 17, 18, 19, 20):
        assert out[i] == texts[i]
    assert passages.remove_repeats(docs).columns == docs.columns and passages.remove_repeats(docs).count() == docs.count()
    assert passages.remove_repeats(none).count() == 0
    report = {r["doc_id"]: r for r in passages.repeat_report(docs.where("doc_id >= 12").select("doc_id", "text")).collect()}
    assert report[14]["owners"] == [13] and report[14]["removed_words"] == 60 and report[15]["component_id"] == 13 and report[12]["removed_words"] == 0


def test_passages_whose_parts_lie_in_lower_documents(spark):
    texts, draw = [], random.Random(17)
    for k in range(20):
        pool = [f"p{k}x{i}" for i in range(400)]
        passage = prose(60, 900 + k, pool).split()
        cut = draw.randrange(25, 36)
        held = [passage[:cut], passage[cut:], passage, passage, passage[10:55]]
        texts += [f"{prose(50, 5000 + 10 * k + n)} {' '.join(part)} {prose(50, 7000 + 10 * k + n)}" for n, part in enumerate(held)]
    got = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["removed_spans"]] for r in passages.repeat_report(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    lower, want = set(), {}
    for i, text in enumerate(texts):
        w = words(text)
        stretches = [tuple(w[k:k + 40]) for k in range(len(w) - 39)]
        want[i] = sorted({k + j for k, s in enumerate(stretches) if s in lower for j in range(40)})
        lower.update(stretches)
    assert {i: [j for low, high in spans for j in range(low, high)] for i, spans in got.items()} == want
    assert sum(map(bool, want.values())) == 40


def test_vectors(spark):
    draw = np.random.default_rng(2)
    centre = draw.normal(size=16)
    rows = [(i, list(map(float, draw.normal(size=16)))) for i in range(60)]
    rows += [(100 + i, list(map(float, centre + 0.15 * draw.normal(size=16)))) for i in range(80)]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [None] * 16), (305, [1e300] * 16), (306, [2e300] * 16), (307, [1.0] * 3), rows[0]]
    table = spark.createDataFrame([(a, b, "x") for a, b in rows], "vec_id long, embedding array<double>, uid string")
    got = covertree.near_duplicate_vectors(table).collect()
    sound = [(i, np.array(v) / np.abs(v).max()) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    link = lambda a, b: len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9
    counts = sorted((i, sum(link(v, w) for k, (_, w) in enumerate(sound) if k != n)) for n, (i, v) in enumerate(sound))
    assert sorted((r["vec_id"], r["n_links"]) for r in got if r["vec_id"] not in (300, 301, 302, 303, 304)) == counts
    assert all(r["n_links"] == 0 and r["kept"] for r in got if 300 <= r["vec_id"] <= 304)
    vectors = dict(sound)
    want = group(vectors, lambda a, b: link(vectors[a], vectors[b]))
    assert all(r["component_id"] == want[r["vec_id"]] for r in got if r["vec_id"] in want)
    assert covertree.near_duplicate_vectors(table.limit(0)).count() == 0


def test_blocks_of_vectors_are_not_moved_for_pairs(spark, monkeypatch):
    plans, keep = [], covertree.stored

    def stored(df, name):
        if name == "links":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(covertree, "BLOCK", 16)
    monkeypatch.setattr(covertree, "SENT", 3 * 16 * 16 * 8, raising=False)
    monkeypatch.setattr(covertree, "stored", stored)
    draw = np.random.default_rng(5)
    middle = draw.normal(size=(6, 16))
    vectors = np.float32(np.concatenate([middle[i % 6] + (0.1 + 0.05 * (i % 5)) * draw.normal(size=(1, 16)) for i in range(240)]))
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(3)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        got = {r["vec_id"]: r for r in covertree.near_duplicate_vectors(table).collect()}
    finally:
        spark.conf.set(threshold, before)
    assert len(plans) > 3 and not any("SortMergeJoin" in plan for plan in plans)
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    assert near.sum() > 1000 and {i: r["n_links"] for i, r in got.items()} == dict(enumerate(near.sum(axis=1).tolist()))
    want = group({i: i for i in range(240)}, lambda a, b: bool(near[a, b]))
    assert all(r["component_id"] == want.get(i, i) for i, r in got.items())


def test_urls(spark):
    urls = [None, "", "no scheme", "http://Example.ORG/es/1?x=/en", "https://a.example.org/en/12#f", "http://example.org/en/2", "ftp://x.com/fr/9",
            "http://x.com/de/", "http://com/de", "http://notcom/de/1", "http://x.net", "://", "http://a.org?u=http://b.com/de/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, key string")
    rules = spark.createDataFrame(queries.URL_RULES, "key string, verdict string")
    got = {r["page_id"]: r for r in urlfilter.judge_urls(pages, rules).collect()}
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = [(k, v) for k, v in queries.URL_RULES if (host == k[:k.index("/")] or host.endswith("." + k[:k.index("/")])) and path.startswith(k[k.index("/"):])]
        rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, "allow"))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict)
    assert urlfilter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urlfilter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).selectExpr("cast(id as string) as key")
    listed = universe.where("cast(key as long) % 7 = 0")
    cascade = urlfilter.Cascade.build(universe, listed, bits_per_key=2)
    assert len(cascade.levels) >= 2
    wrong = universe.withColumn("held", cascade.holds(universe["key"])).where("held <> (cast(key as long) % 7 = 0)")
    assert wrong.count() == 0


def test_leaks(spark, docs, none):
    item = "Alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa. Quebec romeo sierra tango uniform."
    w = item.split()
    told = " ".join("zzz" if k in (2, 5, 9, 12) else x for k, x in enumerate(w))
    half = " ".join(w[:8])
    texts = [f"{prose(50, 1)} {item} {prose(50, 2)}", f"{prose(90, 3)} {told.lower()}", f"{prose(50, 4)} {half} {prose(60, 5)}", "short answer is five", prose(500, 6), None, "",
             f"{prose(10, 8)} tiny run of just six words {prose(10, 9)}", "ab"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, "x"), (4, "tiny run of just six words"), (5, "ab")], "item_id long, text string")
    got = {r["doc_id"]: r["items"] for r in decontaminate.contamination(table, bench).collect()}
    assert got == {0: [1], 1: [1], 2: [], 3: [], 4: [], 5: [], 6: [], 7: [4], 8: [5]}
    assert decontaminate.decontaminate(docs, bench).columns == docs.columns
    assert decontaminate.contamination(table, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(none, bench).count() == 0


def _zipf(n, draw, forms):
    return " ".join(f"z{forms - 1 - int(forms ** draw.random()) % forms}" for _ in range(n))


def _verbatim(spark, items, draw):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"{_zipf(61, draw, 20_000)} {text} {_zipf(60, draw, 20_000)}" for text in items] + [_zipf(300, draw, 20_000) for _ in range(50)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["items"] for r in decontaminate.contamination(table, bench).collect()}
    assert got == {i: [i] if i < len(items) else [] for i in range(len(texts))}


def test_leaks_of_a_large_benchmark(spark):
    draw = random.Random(23)
    _verbatim(spark, [_zipf(draw.randrange(24, 60), draw, 20_000) for _ in range(900)], draw)


def test_leaks_of_long_items(spark):
    draw = random.Random(29)
    _verbatim(spark, [_zipf(n, draw, 20_000) for n in (200, 300, 500, 500, 900)], draw)


def test_common_subsequence():
    draw = random.Random(4)
    for _ in range(200):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(1, 30))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.common_subsequence(np.array(a, np.uint64), np.array(b, np.uint64)) == best[-1][-1]


def ids_of(name, text, end):
    from tokenizers import Tokenizer

    kept = ids_of.__dict__.setdefault(name, Tokenizer.from_file(queries.tokenizer_path(name)))
    return np.array([*kept.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_packing(docs, none):
    name, limits = "byte_bpe_50k.json", packing.Limits(256, 8, 250)
    rows = packing.pack_documents(docs, queries.tokenizer_path(name), 0, limits).collect()
    pieces, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), np.uint16)
        assert len(ids) == r["length"]
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], tuple(ids)))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["start"]))
    want = {}
    for i, t, *_ in documents():
        ids = ids_of(name, t, 0)
        want.setdefault((i, len(ids)), []).append(ids)
    assert {k: sum(len(p[1]) for p in v) for k, v in pieces.items()} == {k: sum(map(len, v)) for k, v in want.items()}
    for key, copies in want.items():
        if len(copies) == 1:
            assert tuple(np.concatenate([p for _, p in sorted(pieces[key])])) == tuple(copies[0])
    for held in sequences.values():
        held.sort()
        assert [o for o, *_ in held] == [sum(n for _, n, _ in held[:k]) for k in range(len(held))]
        assert sum(n for _, n, _ in held) <= 256 and len(held) <= 8
        if len(held) > 1 or held[0][1] < 256:
            assert sum(n - (s == 0) for _, n, s in held) <= 250
    assert packing.pack_documents(none, queries.tokenizer_path(name)).count() == 0


def test_fill_places_every_token():
    draw = np.random.default_rng(3)
    sizes = draw.integers(1, 1024, 300)
    placed = packing.fill(sizes, sizes - 1, packing.Limits(1024, 4, 700))
    got = np.zeros(300, int)
    for piece, cut, length, *_ in placed:
        assert cut == got[piece]
        got[piece] += length
    assert (got == sizes).all()


def test_token_files(spark, docs, none):
    name = "word_bpe_49k.json"
    path = run_dir(spark, "token-files")
    huffman.write_tokens(docs, path, queries.tokenizer_path(name))
    # another session needs nothing but the path
    rows = huffman.open_tokens(spark.newSession(), path).orderBy("start").collect()
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    key = lambda i: (i is not None, i or 0)
    assert [key(r["doc_id"]) for r in rows] == sorted(key(i) for i, *_ in documents())
    assert sorted((key(r["doc_id"]), bytes(r["ids"])) for r in rows) == sorted((key(i), ids_of(name, t, 2).tobytes()) for i, t, *_ in documents())
    empty = run_dir(spark, "token-files")
    huffman.write_tokens(none, empty, queries.tokenizer_path(name))
    assert huffman.open_tokens(spark, empty).count() == 0


@pytest.mark.parametrize("counts", [[5], [1, 1], [1] * 300, [2**k for k in range(30)], [0, 7, 0, 3, 3, 1000, 1]])
def test_code(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, 18)
    used = lengths[counts > 0].astype(float)
    assert used.max() <= 18 and (0.5 ** used).sum() <= 1 and (lengths[counts == 0] == 0).all()
    code = huffman.Code(lengths)
    ids = np.random.default_rng(1).choice(np.flatnonzero(counts), 1000)
    assert (code.decode(*code.encode(ids), len(ids)) == ids).all()


def test_totals(spark):
    rows = spark.createDataFrame([("a", "en", 3), ("a", "en", 4), (None, None, 5), ("b", "de", 0)], "source string, lang string, n long")
    totals = rollup.TokenTotals(spark, run_dir(spark, "totals"))
    assert totals.totals().count() == 0
    assert totals.commit("1", rollup.deltas(rows, "t", "n", 1)) and not totals.commit("1", rollup.deltas(rows, "t", "n", 1))
    totals.commit("2", rollup.deltas(rows.where("n = 4"), "t", "n", -1))
    totals.commit("3", rollup.deltas(rows.where("source = 'b'"), "t", "n", -1))
    got = {tuple(r) for r in totals.totals().collect()}
    assert got == {("a", "en", "t", 1, 3), (None, None, "t", 1, 5)}
    folded = totals.compact(run_dir(spark, "totals"))
    assert {tuple(r) for r in folded.totals().collect()} == got
    # what was folded can't come in again, also after another fold
    again = folded.compact(run_dir(spark, "totals"))
    for one in (folded, again):
        assert not one.commit("1", rollup.deltas(rows, "t", "n", 1)) and {"1", "2", "3"} < set(one.batches())
        assert {tuple(r) for r in one.totals().collect()} == got
    with pytest.raises(ValueError):
        totals.compact(again.path)
    totals.commit("4", rollup.deltas(rows.limit(0), "t", "n", 1))
    assert {tuple(r) for r in totals.totals().collect()} == got


def test_two_writers_of_one_batch(spark, monkeypatch):
    """Both have found the name free; only one of them counts, and whole."""
    rows = spark.createDataFrame([("a", "en", 3), ("b", "en", 4)], "source string, lang string, n long")
    path = run_dir(spark, "totals")
    one, two = rollup.TokenTotals(spark, path), rollup.TokenTotals(spark, path)
    assert one.commit("x/1", rollup.deltas(rows, "t", "n", 1))
    monkeypatch.setattr(two, "committed", lambda batch: False)
    assert not two.commit("x/1", rollup.deltas(rows.where("n = 3"), "t", "n", 1))
    assert one.batches() == ["x/1"]
    assert {tuple(r) for r in one.totals().collect()} == {("a", "en", "t", 1, 3), ("b", "en", "t", 1, 4)}


def _counted(rows):
    """Totals of op10 by the library on whole texts."""
    coders = {n: tokenizers.Tokenizer.from_file(queries.tokenizer_path(f"{n}.json")) for n in ("byte_bpe_50k", "word_bpe_49k")}
    order = lambda r: (r[0] is None, r[0] or 0, r[3] is not None, r[3] or "", r[2] is not None, r[2] or "")
    texts: dict = {}
    for r in rows:
        texts.setdefault(r[1], []).append(r)
    left = [r for text, same in texts.items() for r in (same if text is None else [min(same, key=order)])]
    totals: dict = {}
    for name, coder in coders.items():
        for r in left:
            n = len(coder.encode(r[1], add_special_tokens=False).ids) if r[1] else 0
            docs, tokens = totals.get((r[3], r[2], name), (0, 0))
            totals[r[3], r[2], name] = (docs + 1, tokens + n + (name == "byte_bpe_50k"))
    return {(*key, *sums) for key, sums in totals.items()}


@pytest.mark.parametrize("empty", [False, True])
def test_token_counts(spark, empty):
    """Repeated rows, null ids, null texts and ties, against the library on whole texts."""
    extra = [(1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, "a b", "de", "s"), (3, None, "en", "s"), (3, None, "en", "s"), (None, "a b", "en", "s"),
             (None, "c", None, None), (None, "c", None, "t"), (None, "", "en", None), (7, "", "en", "s"), (8, "tie", "en", "z"), (8, "tie", "en", "y"), (9, "x" * 50_000, "en", "s")]
    rows = [] if empty else [(*r[:3], r[3]) for r in documents()] + extra
    folder = run_dir(spark, "few")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    got = [tuple(r) for r in queries.op10_token_counts(spark, folder).select("source", "lang", "tokenizer", "docs", "tokens").collect()]
    assert len(got) == len(set(got)) and set(got) == _counted(rows)


def test_token_counts_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    got = queries.op10_token_counts(spark, SF).select("source", "lang", "tokenizer", "docs", "tokens")
    assert {tuple(r) for r in got.collect()} == _counted(rows)


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(docs, labels, rows=8).collect()
    assert len(rows) == len(documents()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = {i for i, *_ in documents() if i is not None and zlib.crc32(str(i).encode()) % 3 == 1}
    assert {r["doc_id"] for r in rows if r["held_out"]} == held
    assert quality.score_documents(none, labels).count() == 0
    assert {r["score"] for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}


def _plain_score(net, text):
    """The network's sum by plain loops."""
    blocks = -(-(len(text) + quality.WIDTH) // quality.BLOCK)
    codes = [*text, *[quality.PAD] * (blocks * quality.BLOCK + quality.WIDTH - len(text))]
    tops, means = [], []
    for b in range(blocks):
        seen = []
        for at in range(b * quality.BLOCK, (b + 1) * quality.BLOCK, quality.HOP):
            window = np.concatenate([net["table"][c] for c in codes[at:at + quality.WIDTH]])
            seen.append(np.maximum(window @ net["filters"] + net["offset"], 0) if at < len(text) else np.zeros(quality.FILTERS))
        tops.append(np.max(seen, axis=0))
        means.append(np.mean(seen, axis=0))
    judged = []
    for c in range(max(1, -(-(blocks - 1) // quality.CHUNK_STEP))):
        some = slice(c * quality.CHUNK_STEP, c * quality.CHUNK_STEP + quality.CHUNK_BLOCKS)
        high, low = np.max(tops[some], axis=0), np.sum(means[some], axis=0) / quality.CHUNK_BLOCKS
        judged.append(np.maximum(np.concatenate([high, low * 4]) @ net["hidden"] + net["shift"], 0))
    return np.concatenate([np.mean(judged, axis=0), np.max(judged, axis=0)]) @ net["last"] + net["bias"][0]


def _net(seed):
    net = {k: v.astype(np.float64) for k, v in quality.fresh(seed).items()}
    net["last"] = np.random.default_rng(seed).normal(size=net["last"].shape)
    return net


QUALITY_TEXTS = [b"", b"a", bytes(range(1, 200)) * 9, prose(150, 3).encode(), b"x" * 511, b"y" * 56]


def test_forward_pass_by_plain_loops():
    net = _net(3)
    at = np.cumsum([0, *map(len, QUALITY_TEXTS)])
    got = quality._forward(net, *quality._layout(np.frombuffer(b"".join(QUALITY_TEXTS), np.uint8), at))["score"]
    assert np.allclose(got, [_plain_score(net, t) for t in QUALITY_TEXTS], atol=1e-6)


def test_gradient_by_differences():
    net, label = _net(4), np.array([0, 1, 1, 0, 1, 0])
    at = np.cumsum([0, *map(len, QUALITY_TEXTS)])
    laid = quality._layout(np.frombuffer(b"".join(QUALITY_TEXTS), np.uint8), at)

    def loss():
        s = quality._forward(net, *laid)["score"]
        return np.mean(np.logaddexp(0, s) - label * s)

    grad, draw = quality._gradient(net, quality._forward(net, *laid), *laid, label), np.random.default_rng(5)
    for name, g in grad.items():
        flat, steep = net[name].reshape(-1), g.reshape(-1)
        for i in [*draw.choice(flat.size, min(6, flat.size), replace=False), int(np.abs(steep).argmax())]:
            if name == "table" and i >= quality.PAD * quality.DIM:
                continue  # the padding's vector stays zero
            kept, low_high = flat[i], []
            for shift in (-1e-6, 1e-6):
                flat[i] = kept + shift
                low_high.append(loss())
            flat[i] = kept
            assert abs((low_high[1] - low_high[0]) / 2e-6 - steep[i]) < 1e-3 * max(1, np.abs(steep).max()), name


def test_sample_is_drawn_from_all_parts_of_a_text(spark):
    """Short texts whole; of a long one a chunk from every part; one text of an id that has several, always the same."""
    long = bytes(33 + k // 1000 for k in range(70_000)).decode()
    rows = [(1, "short"), (2, long), (3, "one"), (3, "two"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "doc_id long, quality int")
    first = quality.sample(docs, labels)
    assert first == quality.sample(docs.orderBy(F.desc("text")).repartition(3), labels)
    by_size = sorted(first[0], key=len)
    assert len(by_size) == 4 and by_size[0] == b"" and by_size[2] == b"short" and by_size[1] in (b"one", b"two")
    assert len(by_size[3]) == 512 * 7
    for k in range(7):
        piece = by_size[3][512 * k:512 * (k + 1)]
        assert piece in long.encode()[10_000 * k:10_000 * (k + 1)]


def test_long_text_scores_alike_in_pieces():
    net = quality.fit([b"good words here", b"### @@@ ###"] * 4, [1, 0] * 4, steps=5)
    data = np.frombuffer(prose(20_000, 3).encode(), np.uint8)
    whole = quality._forward(net, *quality._layout(data, np.array([0, len(data)])))["score"][0]
    assert abs(whole - quality._long(net, data, 1 << 14)) < 1e-3


def test_held_out_accuracy(spark):
    rows = queries.op8_quality(spark, "/root/testdata/sf0.01").where("held_out").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))
    assert got == sorted(map(str, con.execute(f"select {', '.join(columns)} from ({queries.SQL[name]})").fetchall()))


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        odd = stage(spark, docs.limit(0), SF)
        assert odd.columns == docs.columns and odd.count() == 0


def test_latent_space_keeps_the_whole_norm_of_every_passage(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{w}" for w in rng.zipf(1.4, n) % 900) for n in rng.integers(12, 120, 60)]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").repartition(5)
    items = decontaminate.read_items(list(enumerate(texts)))
    vocabulary = decontaminate.Vocabulary(items)
    idf = rng.uniform(1, 5, len(vocabulary.words))
    parts = [p for i in items for p in decontaminate._passages(i)]
    space = decontaminate.latent_space(bench, items, vocabulary, idf)
    matrix = np.zeros((len(parts), len(idf)))
    for k, (at, weight) in enumerate(decontaminate._rows_of(parts, vocabulary, idf)):
        matrix[k, at] = weight
    assert np.allclose(np.linalg.norm(matrix @ space, axis=1), 1, atol=1e-4)
    assert np.allclose(np.linalg.norm(matrix @ space, axis=0), np.linalg.svd(matrix)[1][:space.shape[1]][::-1], atol=1e-4)
