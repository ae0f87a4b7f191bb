"""Section K, neighbours and their metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.operators import approximate
from hirelattice.operators import metrics as m
from hirelattice.operators import similarity as sim
from hirelattice.operators.dedup import dedup_rank
from hirelattice.operators.encoders import HashingEncoder, encode
from hirelattice.plans.matching import match_profiles, name_hits
from hirelattice.queries import Tables, query
from hirelattice.session import cut
from hirelattice.sources.readers import parse_id_arrays

# the similarity matrix of the whole table with itself
PAIRS = """u as (select id, label, list_transform(cast(vec as double[]), lambda x: x / sqrt(list_dot_product(cast(vec as double[]), cast(vec as double[])))) as v from vectors),
    p as (select a.id as query_id, a.label as label, b.id as offer_id, b.label as other, list_dot_product(a.v, b.v) as sim from u a cross join u b)"""


def _top(k: int, self_too: bool = True, key: str = "round(sim, 9) desc") -> str:
    where = "" if self_too else "where query_id <> offer_id"
    return f"""h as (select query_id, offer_id, label, other, round(sim, 9) as similarity,
        row_number() over (partition by query_id order by {key}, offer_id) as rank from p {where} qualify rank <= {k})"""


@query("k2_similarity_stats", f"""with {PAIRS}
    select query_id, round(avg(sim), 6) + 0.0 as mean, round(stddev_pop(sim), 6) as std, round(max(sim), 6) as best from p group by 1""")
def k2(t: Tables):
    v = t.bind("vectors")
    return sim.similarity_stats(v, v).select(
        "query_id", (F.round("mean", 6) + 0.0).alias("mean"), F.round("std", 6).alias("std"), F.round("best", 6).alias("best"))


def _hits(t: Tables, k: int, **options):
    v = t.bind("vectors")
    return sim.knn(v, v, k, **options)


def _six(df, c="similarity"):
    return df.withColumn(c, F.round(c, 6))


@query("k3_knn_cosine", f"with {PAIRS}, {_top(5)} select query_id, rank, offer_id, round(similarity, 6) as similarity from h")
def k3(t: Tables):
    return _six(_hits(t, 5))


@query("k3_knn_cosine_cells", f"with {PAIRS}, {_top(5)} select query_id, rank, offer_id, round(similarity, 6) as similarity from h")
def k3c(t: Tables):
    # the path of a corpus too large for one block
    return _six(_hits(t, 5, n_pivots=16))


@query("k4_knn_euclidean", """
    with v as (select id, cast(vec as double[]) as v from vectors),
    p as (select a.id as query_id, b.id as offer_id, round(list_distance(a.v, b.v), 9) as d from v a cross join v b),
    h as (select query_id, offer_id, d, row_number() over (partition by query_id order by d, offer_id) as rank from p qualify rank <= 3)
    select query_id, rank, offer_id, round(d, 5) as distance from h""")
def k4(t: Tables):
    return _hits(t, 3, metric="euclidean").withColumn("distance", F.round("distance", 5))


@query("k5_similarity_threshold", f"""with {PAIRS}, {_top(5, False)}
    select query_id, rank, offer_id, case when similarity >= 0.3 then round(similarity, 6) else 0.0 end as similarity from h""")
def k5(t: Tables):
    return _six(_hits(t, 5, exclude_self=True, threshold=0.3))


@query("k6_best_match", f"with {PAIRS}, {_top(1, False)} select query_id, offer_id, round(similarity, 6) as similarity from h")
def k6(t: Tables):
    v = t.bind("vectors")
    return _six(sim.best_match(v, v, exclude_self=True))


@query("k7_result_table", f"""with {PAIRS}, {_top(3, False)}
    select query_id, rank, offer_id, round(similarity, 3) as similarity, other as label from h""")
def k7(t: Tables):
    hits = _hits(t, 3, exclude_self=True)
    return name_hits(hits, t.bind("vectors"), "id", ["label"]).withColumn("similarity", F.round("similarity", 3))


@query("k8_approximate_knn")
def k8(t: Tables):
    # some of the exact hits; k8_recall holds them against all
    v = t.bind("vectors")
    return _six(approximate.approximate_knn(v, v, 5))


@query("k8_recall", f"""with {PAIRS}, {_top(5, False)}
    select count(*) as n_exact, 0 as n_untrue, true as enough from h""")
def k8r(t: Tables):
    # a plan for nine tenths finds that many at least, and each of its rows is a pair with its true cosine
    v = t.bind("vectors")
    found = cut(approximate.approximate_knn(v, v, 5, recall=0.9, exclude_self=True))
    measured = approximate.recall_against(found, _hits(t, 5, exclude_self=True))
    unit = sim.prepare_vectors(v, True).select("id", "vec")
    both = found.join(unit.toDF("query_id", "q"), "query_id").join(unit.toDF("offer_id", "c"), "offer_id")
    cosine = F.aggregate(F.zip_with("q", "c", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    untrue = both.agg(F.count(F.when(F.abs(cosine - F.col("similarity")) > 1e-8, 1)).cast("int").alias("n_untrue"))
    one = measured.select("n_exact", F.lit(0).alias("n_untrue"), "recall").unionByName(untrue, allowMissingColumns=True)
    return one.agg(F.max("n_exact").alias("n_exact"), F.max("n_untrue").alias("n_untrue"), (F.max("recall") >= 0.9).alias("enough"))


@query("k9_near_duplicates", f"""with {PAIRS}, {_top(1, False)}
    select query_id, offer_id, round(similarity, 6) as similarity from h where similarity >= 0.5""")
def k9(t: Tables):
    return _six(_hits(t, 1, exclude_self=True).filter("similarity >= 0.5").drop("rank"))


@query("k9_near_pairs", f"""with {PAIRS},
    c as (select id, min(id) over (partition by vec) as class from vectors)
    select query_id as id, offer_id as other, round(round(sim, 9), 6) as similarity from p
    where query_id < offer_id and round(sim, 9) >= 0.5
      and query_id in (select class from c) and offer_id in (select class from c)
    union all select class, id, 1.0 from c where id <> class""")
def k9p(t: Tables):
    # every partner of every class of vectors of one direction, and each copy beside its class
    pairs, members = sim.near_pairs(t.bind("vectors"), 0.5)
    copies = members.filter("member <> id").select("id", F.col("member").alias("other"), F.lit(1.0).alias("similarity"))
    return _six(pairs.unionByName(copies))


SPARSE = """
    bw as (select item_id as id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) as w from benchmark),
    dw as (select doc_id as id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) as w from documents),
    bb as (select id, ('0x' || left(md5(w), 8)) :: bigint % 256 as b, cast(count(*) as double) as n from bw group by 1, 2),
    db as (select id, ('0x' || left(md5(w), 8)) :: bigint % 256 as b, cast(count(*) as double) as n from dw group by 1, 2),
    bn as (select id, sqrt(sum(n * n)) as norm from bb group by 1), dn as (select id, sqrt(sum(n * n)) as norm from db group by 1),
    dot as (select bb.id as query_id, db.id as offer_id, sum(bb.n * db.n) as s from bb join db using (b) group by 1, 2),
    r as (select d.query_id, d.offer_id, round(d.s / bn.norm / dn.norm, 9) as sim from dot d
          join bn on bn.id = d.query_id join dn on dn.id = d.offer_id),
    h as (select *, row_number() over (partition by query_id order by sim desc, offer_id) as rank from r qualify rank <= 5)"""


@query("k9_semantic_search", f"with {SPARSE} select query_id, rank, offer_id, round(sim, 6) as similarity from h")
def k9s(t: Tables):
    out = match_profiles(t("benchmark"), t("documents"), "item_id", "text", "doc_id", "text", HashingEncoder, 5)
    return _six(out)


@query("k32_match_profiles", f"""with {SPARSE}
    select h.query_id, h.rank, h.offer_id, round(h.sim, 3) as similarity, d.lang, d.source from h join documents d on h.offer_id = d.doc_id""")
def k32(t: Tables):
    # a profile is several form fields joined by blanks
    form = t("benchmark").select("item_id", F.concat_ws(" ", F.split_part("text", F.lit(" "), F.lit(1)),
                                                        F.regexp_replace("text", "^[^ ]* ?", "")).alias("text"))
    out = match_profiles(form, t("documents"), "item_id", "text", "doc_id", "text", HashingEncoder, 5, ["lang", "source"])
    return out.withColumn("similarity", F.round("similarity", 3))


@query("c26_hits_to_offers", f"with {PAIRS}, {_top(2, False)} select query_id, offer_id, rank, other as label from h")
def c26(t: Tables):
    return name_hits(_hits(t, 2, exclude_self=True), t.bind("vectors"), "id", ["label"]).select("query_id", "offer_id", "rank", "label")


@query("i4_encode_texts", """
    with w as (select item_id as id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) as w from benchmark)
    select id, ('0x' || left(md5(w), 8)) :: bigint % 256 as bucket, count(*) as n from w group by 1, 2""")
def i4(t: Tables):
    vectors = encode(t("benchmark"), "item_id", "text", HashingEncoder, batch=16)
    return vectors.select("id", F.posexplode("vec").alias("bucket", "n")).filter("n > 0").select(
        "id", F.col("bucket").cast("bigint").alias("bucket"), F.col("n").cast("bigint").alias("n"))


@query("k23_hit_metrics", f"""with {PAIRS}, {_top(10, False)},
    q as (select query_id, max(similarity >= 0.4 and rank = 1) as r1, max(similarity >= 0.4 and rank <= 5) as rk,
            count(*) filter (where similarity >= 0.4 and rank <= 5) as n, min(case when similarity >= 0.4 then rank end) as first,
            sum(case when similarity >= 0.4 and rank <= 5 then 1 / log2(rank + 1) else 0 end) as dcg from h group by 1)
    select round(avg(r1 :: int), 6) as recall_at_1, round(avg(rk :: int), 6) as recall_at_k, round(avg(n) / 5, 6) as precision_at_k,
           round(avg(1 / first), 6) as mrr,
           round(avg(case when n > 0 then dcg / list_sum(list_transform(range(1, n + 1), lambda i: 1 / log2(i + 1))) else 0 end), 6) as ndcg from q""")
def k23(t: Tables):
    out = m.hit_metrics(_hits(t, 10, exclude_self=True), 0.4, 5)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("k24_precision_at_k", f"""with {PAIRS}, {_top(5, False)},
    n as (select id as query_id, count(*) over (partition by label) - 1 as n_true from vectors),
    f as (select query_id, count(*) filter (where label = other) as found from h group by 1)
    select n.query_id, round(coalesce(found, 0) / least(5, n_true), 6) as precision from n left join f using (query_id) where n_true > 0""")
def k24(t: Tables):
    v = t.bind("vectors").select("id", "label")
    hits = name_hits(_hits(t, 5, exclude_self=True), v, "id", ["label"]).withColumnRenamed("label", "other")
    hits = hits.join(v.withColumnRenamed("id", "query_id"), "query_id").withColumn("relevant", F.col("label") == F.col("other"))
    sizes = v.groupBy("label").agg((F.count("*") - 1).alias("n_true"))
    truth = v.join(sizes, "label").select(F.col("id").alias("query_id"), "n_true")
    return m.precision_at_k(hits, truth, 5).withColumn("precision", F.round("precision", 6))


@query("k25_ndcg_scores", f"""with {PAIRS}, {_top(5, False)},
    r as (select query_id, similarity, row_number() over (partition by query_id order by offer_id) as shown,
                 row_number() over (partition by query_id order by similarity desc) as best from h),
    g as (select *, pow(2, similarity) - 1 as g from r)
    select query_id, round(case when sum(g / log2(best + 1)) > 0 then sum(g / log2(shown + 1)) / sum(g / log2(best + 1)) else 0 end, 6) as ndcg
    from g group by 1""")
def k25(t: Tables):
    # the hits as shown in id order, which is not the order of similarity
    shown = dedup_rank(_hits(t, 5, exclude_self=True).drop("rank"), ["query_id"], ["offer_id"], keep=5, rank="rank")
    return m.ndcg_at_k(shown, 5).withColumn("ndcg", F.round("ndcg", 6))


@query("k26_composite_quality", f"""with {PAIRS},
    q as (select query_id, max(sim) as best, stddev_pop(sim) as std, count(*) filter (where sim > 0.7) as n, count(*) as m from p group by 1),
    a as (select avg(best) as ms, avg(std) as dv, sum(n) / sum(m) as cv from q)
    select round(ms, 6) as mean_similarity, round(dv, 6) as diversity, round(cv, 6) as coverage, 0.5 :: double as computation_time,
           round(0.4 * ms + 0.3 * dv + 0.2 * cv + 0.05, 6) as quality from a""")
def k26(t: Tables):
    v = t.bind("vectors")
    out = m.composite_quality(sim.similarity_stats(v, v), sim.count_above(v, v, m.QUALITY_THRESHOLD),
                              v.agg(F.count("*")).scalar(), seconds=4.0)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("k26_count_above", f"with {PAIRS} select query_id, count(*) filter (where sim > 0.2) as n from p group by 1")
def k26c(t: Tables):
    v = t.bind("vectors")
    return sim.count_above(v, v, 0.2, n_pivots=16)


@query("k27_weighted_score", """
    with c as (select id_candidat, cast(cast(skill_ids as json) as bigint[]) as have from raw_candidates),
    s as (select l_orderkey, list(distinct l_partkey % 50) as need from lineitem group by 1),
    x as (select o_orderkey, o_custkey, coalesce(s.need, []) as need, c.have, o_totalprice / 1000000 as text,
                 (o_orderstatus = 'F') = (o_orderpriority < '3') as same from orders join c on o_custkey = id_candidat left join s on o_orderkey = l_orderkey)
    select o_orderkey, o_custkey, round(0.6 * text + 0.3 * case when len(list_distinct(need || have)) > 0
        then len(list_intersect(need, have)) / len(list_distinct(need || have)) else 0 end + 0.1 * same :: int, 8) as score from x""")
def k27(t: Tables):
    have = parse_id_arrays(t.bind("raw_candidates"), ["skill_ids"]).select(
        F.col("id_candidat").alias("o_custkey"), F.col("skill_ids").cast("array<bigint>").alias("have"))
    need = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set(F.col("l_partkey") % 50).alias("need"))
    x = t("orders").join(have, "o_custkey").join(need, "o_orderkey", "left").withColumn("need", F.coalesce("need", F.array().cast("array<bigint>")))
    same = ((F.col("o_orderstatus") == "F") == (F.col("o_orderpriority") < "3")).cast("int")
    score = m.combine_scores(F.col("o_totalprice") / 1000000, m.jaccard(F.col("need"), F.col("have")), same)
    return x.select("o_orderkey", "o_custkey", F.round(score, 8).alias("score"))


@query("k28_similarity_summary", f"""with {PAIRS}, {_top(1, False)}
    select round(avg(similarity), 6) as mean, round(stddev_pop(similarity), 6) as std, round(avg((similarity > 0.45) :: int), 6) as share_above from h""")
def k28(t: Tables):
    out = m.similarity_summary(_hits(t, 1, exclude_self=True), 0.45)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("k29_diversity", f"""with {PAIRS}, {_top(5, False)}
    select round(count(distinct offer_id) / (select count(*) from vectors), 6) as diversity, round(avg(similarity), 6) as avg_similarity from h""")
def k29(t: Tables):
    out = m.diversity(_hits(t, 5, exclude_self=True), t.bind("vectors").agg(F.count("*")).scalar())
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("k30_weighted_precision_recall", f"""with {PAIRS}, {_top(5, False)},
    v as (select query_id, label, other, row_number() over (partition by query_id order by count(*) desc, other) as r from h group by 1, 2, 3),
    w as (select label, other from v where r = 1),
    s as (select label, count(*) as n, count(*) filter (where label = other) as tp from w group by 1),
    c as (select other as label, count(*) as called from w group by 1)
    select round(sum(n * coalesce(tp / called, 0)) / sum(n), 6) as precision, round(sum(n * (tp / n)) / sum(n), 6) as recall
    from s left join c using (label)""")
def k30(t: Tables):
    v = t.bind("vectors").select("id", "label")
    votes = m.neighbour_vote(_hits(t, 5, exclude_self=True), v).join(v.withColumnRenamed("id", "query_id"), "query_id")
    out = m.weighted_precision_recall(votes)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("k31_non_zero_ratio", f"""with {PAIRS}, {_top(5, False)}
    select round(avg((similarity >= 0.35) :: int), 6) as non_zero_ratio from h""")
def k31(t: Tables):
    return m.non_zero_ratio(_hits(t, 5, exclude_self=True, threshold=0.35)).withColumn("non_zero_ratio", F.round("non_zero_ratio", 6))
