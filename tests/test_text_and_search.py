import pytest
from pyspark.sql import functions as F

from conftest import rows
from hirelattice.functions import text as x
from hirelattice.operators import search as s
from hirelattice.operators.splits import folds, hash_split
from hirelattice.operators.tfidf import term_counts, tfidf, vocabulary
from hirelattice.operators.upsert import insert, not_found, patch, update, upsert


def _one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t"))).first()[0]


@pytest.mark.parametrize("fn,value,want", [
    (x.clean_v1, "Python-3.8 & SQL   2023!", "python sql"),
    (x.clean_v1, "Été à Œuvre", "été à uvre"),
    (x.clean_v2, "  Été 2023, ça va?\n", "ete 2023  ca va"),
    (x.clean_v2, "Ā œ b", "a   b"),
    (x.clean_v3, "L'Été  2023!", "L'Ete"),
    (x.strip_accents, "àéîõüçñ ß Ĳ ệ", "aeiouçn ß Ĳ e".replace("ç", "c")),
    (x.sanitize_csv, 'a\r\nb\n"c"\x07', 'a b ""c""'),
    (x.sanitize_csv, None, ""),
    (x.reduce_title, "Vendeur / Vendeuse en magasin", "Vendeur en magasin"),
    (x.first_three, "A1101", "A11"), (x.first_three, "A1", None),
    (x.shorten, "y" * 501, "y" * 500 + "..."), (x.shorten, "y" * 500, "y" * 500),
])
def test_text(spark, fn, value, want):
    assert _one(spark, value, fn) == want


def test_empty_and_special_texts(spark):
    for fn in (x.clean_v1, x.clean_v2, x.clean_v3):
        assert _one(spark, "", fn) == "" and _one(spark, "!!! ???", fn) == "" and _one(spark, None, fn) is None


def test_lemmas(spark):
    df = spark.createDataFrame([(1, "Les données et 12 dater"), (2, "")], "id long, t string")
    lemmas = spark.createDataFrame([("donnees", "donnee")], "word string, lemma string")
    stop = spark.createDataFrame([("les",), ("et",)], "word string")
    assert rows(x.lemmatize(df, "id", "t", lemmas, stop)) == [(1, "donnee data"), (2, "")]


def test_tfidf_bounds(spark):
    df = spark.createDataFrame([(1, "python sql python"), (2, "python java"), (3, "sql data")], "id long, t string")
    out = tfidf(df, "id", "t")
    norms = out.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    assert all(abs(r["n"] - 1) < 1e-9 for r in norms.collect())
    assert {r[0] for r in tfidf(df, "id", "t", max_features=2).select("term").distinct().collect()} == {"python", "sql"}
    assert "python sql" in {r[0] for r in tfidf(df, "id", "t", (1, 2)).select("term").distinct().collect()}
    assert {r[0] for r in tfidf(df, "id", "t", min_df=2).select("term").distinct().collect()} == {"python", "sql"}


def test_tfidf_with_bounded_vocabulary_moves_the_texts_only(spark):
    # an id may repeat or be null: its texts count as one
    df = spark.createDataFrame([(1, "python sql python"), (1, "sql java"), (None, "sql data"), (None, "data"), (4, None), (5, "python")], "id long, t string")
    bounded = tfidf(df, "id", "t", max_features=3)
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not [line for line in dealt if "id#" in line and "term#" in line] and "SortMergeJoin" not in plan
    terms = vocabulary(term_counts(df, "id", "t"), F.lit(6), max_features=3)
    want = {(1, "python"): 2.0, (1, "sql"): 2.0, (None, "sql"): 1.0, (None, "data"): 2.0, (5, "python"): 1.0}
    idf = {r["term"]: r["idf"] for r in terms.collect()}
    assert set(idf) == {"python", "sql", "data"}
    for out in (bounded, tfidf(df, "id", "t", max_features=3, terms=terms)):
        got = {(r["id"], r["term"]): r["weight"] for r in out.collect()}
        assert set(got) == set(want)
        for (i, term), w in got.items():
            norm = sum((n * idf[x]) ** 2 for (j, x), n in want.items() if j == i) ** 0.5
            assert w == pytest.approx(want[i, term] * idf[term] / norm)


@pytest.fixture(scope="module")
def offers(spark):
    return spark.createDataFrame([(1, "Data Analyst", "sql 100%", "CDI", 10.0), (2, "Chef", None, "CDD", None), (3, "Data Engineer", "spark_sql", "CDI", 30.0)],
                                 "id long, title string, skills string, contract string, salary double")


def _ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("op,value,want", [
    ("eq", 10.0, [1]), ("neq", 10.0, [3]), ("gt", 10.0, [3]), ("gte", 10.0, [1, 3]), ("lt", 30.0, [1]), ("lte", 30.0, [1, 3]),
    ("in", [10.0, 99.0], [1]), ("between", [5, 20], [1])])
def test_operators(offers, op, value, want):
    assert _ids(offers.filter(s.build_predicate([s.Filter("salary", op, value)]))) == want


def test_filters_on_one_field_and_refusals(offers):
    both = [s.Filter("salary", "gt", 5), s.Filter("salary", "lt", 20)]
    assert _ids(offers.filter(s.build_predicate(both))) == [1]
    for bad in (s.Filter("salary", "between", [1]), s.Filter("salary", "in", "1,2"), s.Filter("salary", "near", 1)):
        with pytest.raises(ValueError):
            s.one_filter(bad)
    with pytest.raises(ValueError):
        s.search(offers, s.SearchRequest([s.Filter("nope", "eq", 1)]), ["title"])
    with pytest.raises(ValueError):
        s.page(offers, [F.col("id")], 1, 101)


def test_wildcards_are_a_choice(offers):
    assert _ids(offers.filter(s.free_text(["skills"], "0%"))) == [1]
    assert _ids(offers.filter(s.free_text(["title", "skills"], "k_s", wildcards=True))) == [3]
    assert _ids(offers.filter(s.free_text(["title", "skills"], "a%n", wildcards=True))) == [1, 3]


def test_staged_search(offers):
    stages = [s.TermStage(["data", "sql"], ["title", "skills"]), s.TermStage([], ["contract"])]
    assert _ids(s.multi_term_search(offers, stages)) == [1, 1, 3, 3]
    assert _ids(s.multi_term_search(offers, stages, one_row_per_term=False)) == [1, 3]
    assert _ids(s.multi_term_search(offers, [s.TermStage([], ["title"])])) == []
    assert _ids(s.multi_term_search(offers, stages, "CDI, 1", ["contract", "id"], one_row_per_term=False)) == [1]


def test_page_and_envelope(offers):
    page, envelope = s.search(offers, s.SearchRequest(sort=[("salary", "asc")], page=2, size=2), ["title"])
    assert [r["id"] for r in page.collect()] == [2]
    assert tuple(envelope.first()) == (3, 2, 2, 2, False, True)


def test_coercion():
    assert (s.coerce("3"), s.coerce("3.5"), s.coerce("x")) == (3, 3.5, "x")


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, name string, gone double")
    new = spark.createDataFrame([(2, "B", 5), (3, "C", 6), (3, "D", 7)], "id long, name string, extra int")
    assert rows(upsert(old, new, ["id"])) == [(1, "a", 1.0, None), (2, "B", None, 5), (3, "C", None, 6), (3, "D", None, 7)]
    assert rows(upsert(old, new, ["id"], "sync_all", [F.col("extra").desc()])) == [(1, "a", None), (2, "B", 5), (3, "D", 7)]
    changes = spark.createDataFrame([(1, None, 9.0), (8, "x", 1.0)], "id long, name string, gone double")
    assert rows(update(old, changes, "id")) == [(1, None, 9.0), (2, "b", 2.0)]
    assert rows(patch(old, changes, "id")) == [(1, "a", 9.0), (2, "b", 2.0)]
    twice = spark.createDataFrame([(1, "p", 1.0), (1, "q", None), (None, "r", 0.0), (None, "s", 0.0)], "id long, name string, gone double")
    assert rows(update(old, twice, "id", [F.col("name").desc()])) == [(1, "q", None), (2, "b", 2.0)]
    assert rows(patch(old, twice, "id", [F.col("name").desc()])) == [(1, "q", 1.0), (2, "b", 2.0)]
    for change in (update, patch):
        with pytest.raises(Exception, match="repeated"):
            change(old, twice, "id").collect()
    assert rows(not_found(old, changes, "id")) == [(8,)]
    assert rows(insert(old, changes.drop("gone"))).count((8, "x", None)) == 1


def test_splits_do_not_depend_on_partitions(spark):
    df = spark.range(3000).withColumn("label", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))))
    a = hash_split(df.repartition(7), "id", stratify="label")
    b = hash_split(df.coalesce(1), "id", stratify="label")
    assert rows(a.select("id", "is_train")) == rows(b.select("id", "is_train"))
    for r in a.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_train").alias("k")).collect():
        assert r["k"] == -(-r["n"] * 8 // 10)
    assert folds(df, "id", 4).select("fold").distinct().count() == 4
