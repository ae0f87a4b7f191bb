"""Section D and G: aggregates, profiles, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.operators import olap, star
from hirelattice.operators.dedup import dedup_rank
from hirelattice.queries import Tables, query


@query("d1_string_aggregate", """
    select b.id_offre, string_agg(distinct d.skill, ', ' order by d.skill) as competences,
           string_agg(distinct d.type, ' | ' order by d.type) as types
    from offer_skills b join dim_skill d on b.id_competence = d.id_competence group by 1""")
def d1s(t: Tables):
    rows = t.bind("offer_skills").join(t.bind("dim_skill"), "id_competence")
    return star.join_values(rows, ["id_offre"], {"competences": ("skill", ", "), "types": ("type", " | ")})


@query("d2_group_by_many_keys", """
    select o_orderstatus, o_orderpriority, c_mktsegment, n_name, r_name, year(o_orderdate) as y, month(o_orderdate) as m,
           count(*) as n, round(sum(o_totalprice), 2) as total
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey group by all""")
def d2(t: Tables):
    named = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t("orders").join(named, F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("o_orderstatus", "o_orderpriority", "c_mktsegment", "n_name", "r_name",
                        F.year("o_orderdate").cast("bigint").alias("y"), F.month("o_orderdate").cast("bigint").alias("m")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("d6_weighted_score", """
    select doc_id, round(coalesce(l.quality, 0) * 0.6 + coalesce(l.toxic, 0) * 0.4, 6) as score
    from documents d left join labels l using (doc_id)""")
def d6(t: Tables):
    score = F.coalesce("quality", F.lit(0)) * F.lit(0.6) + F.coalesce("toxic", F.lit(0)) * F.lit(0.4)
    return t("documents").join(t("labels"), "doc_id", "left").select("doc_id", F.round(score, 6).alias("score"))


def _places(t):
    return t.bind("places").withColumnRenamed("id_lieu", "l_suppkey")


@query("d8_top_places", """
    select ville, latitude, longitude, cast(count(*) as bigint) as n_offers from lineitem join places on l_suppkey = id_lieu
    where latitude is not null and longitude is not null group by 1, 2, 3 order by n_offers desc, 1, 2, 3 limit 5""")
def d8(t: Tables):
    return olap.top_places(t("lineitem"), _places(t), "l_suppkey", ["ville", "latitude", "longitude"], 5)


@query("d9_top_regions", """
    select region, latitude, longitude, cast(count(*) as bigint) as n_offers from lineitem join places on l_suppkey = id_lieu
    where latitude is not null and longitude is not null group by 1, 2, 3 order by n_offers desc, 1, 2, 3 limit 15""")
def d9(t: Tables):
    return olap.top_places(t("lineitem"), _places(t), "l_suppkey", ["region", "latitude", "longitude"], 15)


@query("d9_per_region", """
    select region, cast(count(*) as bigint) as n_offers from lineitem join places on l_suppkey = id_lieu
    where latitude is not null and longitude is not null group by 1""")
def d9r(t: Tables):
    return olap.top_places(t("lineitem"), _places(t), "l_suppkey", ["region"], None)


def _labelled(t):
    return t("documents").join(t("labels"), "doc_id", "left")


@query("d10_value_counts_null_bucket", """
    select coalesce(cast(quality as varchar), 'Non étiqueté') as value, count(*) as n from documents left join labels using (doc_id) group by 1""")
def d10(t: Tables):
    return olap.value_counts(_labelled(t), "quality", null_label=olap.NO_LABEL)


@query("d11_top_n_null_bucket", """
    select coalesce(case when toxic = 0 then source end, 'Non étiqueté') as value, count(*) as n
    from documents left join labels using (doc_id) group by 1 order by n desc, 1 limit 10""")
def d11(t: Tables):
    return olap.value_counts(_labelled(t).withColumn("v", F.when(F.col("toxic") == 0, F.col("source"))), "v", 10, olap.NO_LABEL)


@query("d12_delimited_counts", """
    with w as (select string_agg(distinct p_name, ', ') as s from lineitem join part on l_partkey = p_partkey group by l_orderkey),
    x as (select trim(unnest(string_split(s, ','))) as value from w)
    select value, count(*) as n from x group by 1 order by n desc, 1 limit 20""")
def d12(t: Tables):
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    texts = star.join_values(joined, ["l_orderkey"], {"competences": ("p_name", ", ")})
    return olap.delimited_counts(texts, "competences", ",", 20)


@query("d13_value_counts", """
    select value, count(*) as n from (select cast(month(o_orderdate) as varchar) as value from orders) group by 1 order by n desc, 1 limit 5""")
def d13(t: Tables):
    return olap.value_counts(t("orders").withColumn("m", F.month("o_orderdate")), "m", 5)


@query("d13_value_counts_truncated", """
    select left(p_name, 5) || '...' as value, count(*) as n from part group by 1 order by n desc, 1 limit 15""")
def d13t(t: Tables):
    return olap.value_counts(t("part").withColumn("s", F.concat(F.substring("p_name", 1, 5), F.lit("..."))), "s", 15)


@query("d14_missing_profile", """
    with x as (select count(*) as n, count(*) - count(contract_type) as a, count(*) - count(contract_duration) as b,
                      count(*) - count(experience_required) as c, count(*) - count(sector) as d from offers)
    select u.column_name, u.n_missing, round(u.n_missing * 100.0 / x.n, 6) as pct from x, lateral (values
      ('contract_type', a), ('contract_duration', b), ('experience_required', c), ('sector', d)) u(column_name, n_missing)""")
def d14(t: Tables):
    return olap.missing_profile(t.bind("offers").select("contract_type", "contract_duration", "experience_required", "sector"))


@query("d15_contingency", "select lang, source, count(*) as n from documents group by 1, 2")
def d15(t: Tables):
    return olap.contingency(t("documents"), "lang", "source")


@query("d15_contingency_top", """
    with a as (select p_name from part group by 1 order by count(*) desc, 1 limit 10),
    b as (select p_brand from part group by 1 order by count(*) desc, 1 limit 10)
    select p_name, p_brand, count(*) as n from part where p_name in (from a) and p_brand in (from b) group by 1, 2""")
def d15t(t: Tables):
    return olap.contingency(t("part"), "p_name", "p_brand", 10)


@query("d15_crosstab", """
    select o_orderstatus, count(*) filter (where o_orderpriority = '1-URGENT') as urgent,
           count(*) filter (where o_orderpriority = '5-LOW') as low from orders group by 1""")
def d15c(t: Tables):
    out = olap.crosstab(t("orders"), "o_orderstatus", "o_orderpriority", ["1-URGENT", "5-LOW"])
    return out.select("o_orderstatus", F.col("`1-URGENT`").alias("urgent"), F.col("`5-LOW`").alias("low"))


def _profile_sql(c, table):
    return (f"select '{c}' as column_name, count(*) as n_rows, count({c}) as n_known, max(length(cast({c} as varchar))) as max_length, "
            f"cast(min({c}) as varchar) as least, cast(max({c}) as varchar) as greatest, count(distinct {c}) as n_distinct from {table}")


@query("d16_column_profile", " union all ".join(_profile_sql(c, "orders") for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")))
def d16(t: Tables):
    return olap.profile(t("orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query("d16_describe", " union all ".join(
    f"select '{c}' as column_name, count({c}) as n, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, "
    f"cast(min({c}) as double) as least, cast(max({c}) as double) as greatest from lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount")))
def d16d(t: Tables):
    out = olap.describe(t("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query("d17_total_rows", " union all ".join(f"select '{n}' as entity, count(*) as total from {n}" for n in (
    "region", "nation", "supplier", "customer", "part", "orders", "lineitem", "documents")))
def d17(t: Tables):
    parts = [t(n).agg(F.count("*").alias("total")).select(F.lit(n).alias("entity"), "total") for n in (
        "region", "nation", "supplier", "customer", "part", "orders", "lineitem", "documents")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("d19_counters_by_label", """
    select event_type, count(*) as n, round(sum(value), 4) as total, round(sum(value) / count(*), 6) as average from events group by 1""")
def d19(t: Tables):
    return olap.counters(t("events"), "event_type", "value").withColumns(
        {"total": F.round("total", 4), "average": F.round("average", 6)})


@query("g1_union_labelled", """
    select 'quality' as source, doc_id from labels where quality = 1 union all select 'toxic', doc_id from labels where toxic = 1
    union all select 'neither', doc_id from labels where quality = 0 and toxic = 0""")
def g1(t: Tables):
    # the cases as one pass over the table
    cases = F.array_compact(F.array(
        F.when(F.col("quality") == 1, F.lit("quality")), F.when(F.col("toxic") == 1, F.lit("toxic")),
        F.when((F.col("quality") == 0) & (F.col("toxic") == 0), F.lit("neither"))))
    return t("labels").select(F.explode(cases).alias("source"), "doc_id")


@query("g2_distinct", "select distinct l_orderkey, l_linenumber from lineitem")
def g2(t: Tables):
    return t("lineitem").select("l_orderkey", "l_linenumber").distinct()


@query("g4_drop_duplicates_keep_first", """
    select doc_id, lang, source from documents qualify row_number() over (partition by text order by doc_id) = 1""")
def g4(t: Tables):
    keyed = t("documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("_text"))
    return dedup_rank(keyed, ["_text"], ["doc_id"]).drop("_text")


@query("g6_intersection_size", """
    with a as (select l_orderkey, list(distinct l_partkey) as x from lineitem where l_returnflag = 'A' group by 1),
    b as (select l_orderkey, list(distinct l_partkey) as x from lineitem where l_linestatus = 'F' group by 1)
    select l_orderkey, len(list_intersect(a.x, b.x)) as n_common from a join b using (l_orderkey)""")
def g6(t: Tables):
    def ids(cond):
        return F.collect_set(F.when(cond, F.col("l_partkey")))

    # both lists in one aggregate
    both = t("lineitem").groupBy("l_orderkey").agg(ids(F.col("l_returnflag") == "A").alias("a"), ids(F.col("l_linestatus") == "F").alias("b"))
    return both.filter((F.size("a") > 0) & (F.size("b") > 0)).select("l_orderkey", F.size(F.array_intersect("a", "b")).cast("bigint").alias("n_common"))


@query("g7_distinct_over_union", """
    select count(distinct id) as n from (select l_partkey as id from lineitem union all select p_partkey from part)""")
def g7(t: Tables):
    ids = t("lineitem").select(F.col("l_partkey").alias("id")).union(t("part").select("p_partkey"))
    # merged on the map side first
    return ids.distinct().agg(F.count("*").alias("n"))
