"""Section K: transforms, models, splits, parameter search."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.operators import decomposition, learning as ml
from hirelattice.operators.similarity import knn
from hirelattice.operators.splits import folds, hash_split
from hirelattice.operators.tfidf import term_counts, tfidf, vocabulary
from hirelattice.queries import Tables, query
from hirelattice.queries.similarity import PAIRS, _top
from hirelattice.session import cut, run_dir

HASH = "('0x' || left(md5('42:' || cast({} as varchar)), 8)) :: bigint"


@query("k10_standardize", """
    with l as (select id, unnest(cast(vec as double[])) as x, generate_subscripts(vec, 1) as dim from vectors),
    s as (select dim, avg(x) as mu, stddev_pop(x) as sd from l group by 1)
    select id, dim, round((x - mu) / sd, 6) as z from l join s using (dim)""")
def k10(t: Tables):
    out = ml.standardize(t.bind("vectors"))
    return out.select("id", F.posexplode("vec").alias("pos", "z")).select("id", (F.col("pos") + 1).cast("bigint").alias("dim"), F.round("z", 6).alias("z"))


@query("k11_explained_variance")
def k11(t: Tables):
    return ml.reduce_dims(t.bind("vectors"), 8)[1]


@query("k11_reduced_vectors")
def k11v(t: Tables):
    return ml.reduce_dims(t.bind("vectors"), 2)[0].select("id", F.round(F.abs(F.col("vec")[0]), 6).alias("x"), F.round(F.abs(F.col("vec")[1]), 6).alias("y"))


@query("k11_singular_values", """
    with l as (select id, unnest(cast(vec as double[])) as x, generate_subscripts(vec, 1) as d from vectors),
    g as (select a.d as i, b.d as j, sum(a.x * b.x) as x from l a join l b on a.id = b.id group by 1, 2)
    select round(sum(x) filter (where i = j), 4) as squares, round(sum(x * x), 4) as fourth_powers from g""")
def k11s(t: Tables):
    # all of them: their squares add up to the trace of A'A, their fourth powers to that of its square
    rows, dim = decomposition.dense_rows(t.bind("vectors"))
    values = decomposition.truncated_svd(rows, dim, dim).table(t.bind("vectors"))
    square = F.col("singular_value") * F.col("singular_value")
    return values.agg(F.round(F.sum(square), 4).alias("squares"), F.round(F.sum(square * square), 4).alias("fourth_powers"))


@query("k11_truncated_svd")
def k11t(t: Tables):
    # sparse text vectors, not centred; a test holds the values against a full decomposition
    docs = t("documents")
    terms = cut(vocabulary(term_counts(docs, "doc_id", "text"), docs.agg(F.count("*")).scalar(), max_features=5000))
    weights = tfidf(docs, "doc_id", "text", max_features=5000, terms=terms)
    rows, dim = decomposition.sparse_rows(weights, "doc_id", "term", "weight", terms)
    return decomposition.truncated_svd(rows, dim, 20).table(t("documents"))


@query("k12_kmeans")
def k12(t: Tables):
    return ml.kmeans(t.bind("vectors"))[0].groupBy("cluster").agg(F.count("*").alias("n"))


@query("k12_kmeans_samples")
def k12s(t: Tables):
    return ml.kmeans(t.bind("vectors"))[2].select("cluster", "id")


@query("k13_silhouette")
def k13(t: Tables):
    return ml.kmeans(t.bind("vectors"))[1]


@query("k13_silhouette_of_labels", """
    with v as (select id, label, cast(vec as double[]) as v from vectors),
    p as (select a.id, a.label, b.label as other, sum(list_distance(a.v, b.v)) as total, count(*) as n from v a cross join v b group by 1, 2, 3),
    m as (select id, max(total / (n - 1)) filter (where label = other and n > 1) as a, min(total / n) filter (where label <> other) as b from p group by 1)
    select count(*) as n, round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from m""")
def k13l(t: Tables):
    return decomposition.silhouette(t.bind("vectors"), "label").withColumn("silhouette", F.round("silhouette", 6))


def _labelled(t: Tables):
    rows = t("documents").join(t("labels"), "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("quality"))
    return hash_split(rows, "doc_id", stratify="quality")


@query("k14_text_classifier")
def k14(t: Tables):
    return ml.classify_text(_labelled(t), "text", "quality")[0]


@query("k15_class_probabilities", """
    select doc_id, true as sums_to_one, cast(2 as bigint) as classes from documents join labels using (doc_id)""")
def k15(t: Tables):
    p = ml.classify_text(_labelled(t), "text", "quality")[1]
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    return p.select("doc_id", (F.abs(total - 1) < 1e-9).alias("sums_to_one"), F.size("probabilities").cast("bigint").alias("classes"))


FEATURES = ["n_lines", "quantity", "price"]


def _order_features(t: Tables):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"))
    rows = t("orders").select("o_orderkey", "o_totalprice").join(lines, "o_orderkey")
    return hash_split(rows, "o_orderkey", 0.75)


@query("k16_elastic_net")
def k16(t: Tables):
    return ml.regress_elastic_net(_order_features(t), FEATURES, "o_totalprice")


@query("k17_random_forest")
def k17(t: Tables):
    return ml.regress_forest(_order_features(t), FEATURES, "o_totalprice", trees=100, depth=6)


@query("k18_hash_split", f"select c_custkey, {HASH.format('c_custkey')} % 100 < 80 as is_train from customer")
def k18(t: Tables):
    return hash_split(t("customer"), "c_custkey").select("c_custkey", "is_train")


@query("k18_stratified_split", f"""
    select c_custkey, row_number() over (partition by c_mktsegment order by {HASH.format('c_custkey')}, c_custkey)
        <= ceil(count(*) over (partition by c_mktsegment) * 0.8) as is_train from customer""")
def k18s(t: Tables):
    return hash_split(t("customer"), "c_custkey", stratify="c_mktsegment").select("c_custkey", "is_train")


@query("k19_folds", f"select o_orderkey, cast({HASH.format('o_orderkey')} % 5 as bigint) as fold from orders")
def k19(t: Tables):
    return folds(t("orders"), "o_orderkey").select("o_orderkey", F.col("fold").cast("bigint").alias("fold"))


GRID = ml.grid([3, 5, 10], [0.2, 0.3, 0.4])
DRAWS = ml.draws(12, (1, 10), (0.1, 0.5))


def _search_sql(configs):
    rows = ", ".join(f"({i}, {k}, {t})" for i, (k, t) in enumerate(configs))
    return f"""with {PAIRS}, {_top(10, False)},
    c(run, k, threshold) as (values {rows}),
    q as (select cast(run as bigint) as run, cast(k as bigint) as k, cast(threshold as double) as threshold, query_id,
                 max((similarity >= threshold) :: int) as found,
                 count(*) filter (where similarity >= threshold) as n, sum(similarity) as total, count(*) as m
          from h, c where rank <= k group by 1, 2, 3, 4)
    select run, k, threshold, round(avg(found), 6) as recall, round(sum(n) / sum(m), 6) as precision,
           round(sum(total) / sum(m), 6) as mean_similarity from q group by 1, 2, 3"""


def _searched(t: Tables, configs):
    v = t.bind("vectors")
    out = ml.search_params(knn(v, v, max(k for k, _ in configs), exclude_self=True), configs)
    return out.withColumns({c: F.round(c, 6) for c in ("recall", "precision", "mean_similarity")})


@query("k20_grid_search", _search_sql(GRID))
def k20(t: Tables):
    return _searched(t, GRID)


FOLDS = 3
_CONFIGS = ", ".join(f"({i}, {k}, {t})" for i, (k, t) in enumerate(GRID))


@query("k20_matching_folds", f"""with {PAIRS},
    f as (select id, label, {HASH.format('id')} % {FOLDS} as part from vectors),
    g as (select unnest(range({FOLDS})) as fold),
    h as (select g.fold, query_id, p.label = p.other as relevant, round(sim, 9) as similarity,
                 row_number() over (partition by g.fold, query_id order by round(sim, 9) desc, offer_id) as rank
          from p join f on f.id = offer_id join g on g.fold <> f.part where query_id <> offer_id qualify rank <= 10),
    n as (select g.fold, q.id as query_id, count(c.id) as n_true from vectors q cross join g
          left join f c on c.label = q.label and c.id <> q.id and c.part <> g.fold group by 1, 2),
    c(run, k, threshold) as (values {_CONFIGS}),
    x as (select run, k, threshold, fold, query_id, rank, relevant and similarity >= threshold and rank <= 5 as found,
                 case when similarity >= threshold then similarity else 0 end as s from h, c where rank <= k),
    y as (select *, row_number() over (partition by run, fold, query_id order by s desc, rank) as best from x),
    q as (select run, k, threshold, fold, query_id, count(*) filter (where found) as found, avg(s) as mean,
                 sum((pow(2, s) - 1) / log2(rank + 1)) as dcg, sum((pow(2, s) - 1) / log2(best + 1)) as ideal from y group by all)
    select cast(run as bigint) as run, cast(k as bigint) as k, cast(threshold as double) as threshold, cast(q.fold as bigint) as fold,
           round(avg(case when n_true > 0 then found / least(5, n_true) end), 6) as precision,
           round(avg(case when ideal > 0 then dcg / ideal else 0 end), 6) as ndcg, round(avg(mean), 6) as mean_similarity
    from q join n on n.fold = q.fold and n.query_id = q.query_id group by 1, 2, 3, 4""")
def k20m(t: Tables):
    v = t.bind("vectors")
    named = v.select("id", "label")
    hits = ml.fold_hits(v.select("id", "vec"), v.select("id", "vec"), 10, FOLDS, exclude_self=True)
    both = hits.join(named.toDF("query_id", "label"), "query_id").join(named.toDF("offer_id", "other"), "offer_id")
    truth = ml.fold_truth(named, named, FOLDS, exclude_self=True)
    out = ml.cross_validate_matching(both.withColumn("relevant", F.col("label") == F.col("other")), truth, GRID)
    out = out.withColumn("fold", F.col("fold").cast("bigint"))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "ndcg", "mean_similarity")})


@query("k20_cross_validation")
def k20c(t: Tables):
    return ml.cross_validate(_order_features(t), "o_orderkey", FEATURES, "o_totalprice", [0.1, 1.0], [0.0, 0.5], n_folds=3)


@query("k21_random_search", _search_sql(DRAWS))
def k21(t: Tables):
    return _searched(t, DRAWS)


@query("k22_run_table", _search_sql(GRID))
def k22(t: Tables):
    return ml.store_runs(t.spark, _searched(t, GRID), run_dir(t.spark, "runs"))
