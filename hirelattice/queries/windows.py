"""Section E: window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.operators import olap
from hirelattice.operators.dedup import clean_offers, dedup_rank
from hirelattice.operators.domains import scored_matches
from hirelattice.operators.numbering import number_rows
from hirelattice.queries import Tables, query
from hirelattice.queries.matchers import DOMAIN_TOKENS, _scored_ctes


@query("e1_clean_offers", """
    select id_offre, id_local, contract_type, cast(1 as bigint) as rn from raw_offers
    qualify row_number() over (partition by id_local order by date_extraction nulls last, id_offre desc) = 1""")
def e1(t: Tables):
    return clean_offers(t.bind("raw_offers")).select("id_offre", "id_local", "contract_type", "rn")


@query("e2_best_by_flags", """
    select l_orderkey, l_partkey, l_linenumber from lineitem qualify row_number() over (partition by l_orderkey
      order by l_returnflag = 'A' desc, l_linestatus = 'F' desc, l_quantity desc, l_partkey, l_linenumber, l_suppkey) = 1""")
def e2(t: Tables):
    order = [(F.col("l_returnflag") == "A").desc(), (F.col("l_linestatus") == "F").desc(), F.col("l_quantity").desc(),
             F.col("l_partkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    return dedup_rank(t("lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_partkey", "l_linenumber")


@query("e3_newest_per_key", """
    select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1""")
def e3(t: Tables):
    return dedup_rank(t("orders"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("e4_best_per_text", f"""
    with {DOMAIN_TOKENS}, {_scored_ctes('a', 'sector')}
    select id_domaine, id_local from a_s where body is not null
    qualify row_number() over (partition by body order by pct desc, id_local, id_domaine) = 1""")
def e4(t: Tables):
    o = t.bind("domain_offers")
    scored = scored_matches(t.bind("domains"), o, "sector", t.bind("stopwords")).filter("id_local is not null")
    keyed = scored.join(o.select("id_local", F.sha2("sector", 256).alias("_text")), "id_local")
    return dedup_rank(keyed, ["_text"], [F.col("pct").desc(), "id_local", "id_domaine"]).select("id_domaine", "id_local")


@query("e5_best_per_nullable_key", """
    select source_key, lang, doc_id from (select coalesce(case when lang <> 'en' then source end, 'NULL_SECTOR') as source_key, lang, doc_id, n_chars from documents)
    qualify row_number() over (partition by source_key, lang order by n_chars desc, doc_id) = 1""")
def e5(t: Tables):
    d = t("documents").withColumn("source_key", F.coalesce(F.when(F.col("lang") != "en", F.col("source")), F.lit("NULL_SECTOR")))
    return dedup_rank(d, ["source_key", "lang"], [F.col("n_chars").desc(), "doc_id"]).select("source_key", "lang", "doc_id")


@query("e6_global_row_number", """
    select c_custkey, row_number() over (order by c_mktsegment, c_custkey) as row_id from customer""")
def e6(t: Tables):
    return number_rows(t("customer").select("c_mktsegment", "c_custkey"), ["c_mktsegment", "c_custkey"]).select("c_custkey", "row_id")


@query("e7_top_k_per_query", """
    select l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rank from (
      select *, row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber) as rank from lineitem) where rank <= 3""")
def e7(t: Tables):
    top = dedup_rank(t("lineitem"), ["l_suppkey"], [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"], keep=3, rank="rank")
    return top.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "rank")


@query("e8_lag_feature", """
    with d as (select event_type, cast(ts as date) as day, round(sum(value), 4) as demand from events group by 1, 2),
    l as (select *, lag(demand) over (partition by event_type order by day) as lg from d)
    select event_type, strftime(day, '%Y-%m-%d') as day, demand,
           coalesce(lg, first_value(lg ignore nulls) over (partition by event_type order by day rows between current row and unbounded following)) as lagged
    from l""")
def e8(t: Tables):
    daily = t("events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.round(F.sum("value"), 4).alias("demand"))
    return olap.lag_feature(daily, "day", "demand", ["event_type"]).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("f6_top_k_by_score", "select doc_id, n_chars from documents order by n_chars desc, doc_id limit 25")
def f6(t: Tables):
    return t("documents").select("doc_id", "n_chars").orderBy(F.col("n_chars").desc(), "doc_id").limit(25)
