"""Sections B and F: filters, search, sorting, paging."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from hirelattice.operators import search as s
from hirelattice.queries import Tables, query

TEXT = ["title", "description", "competences", "nom_domaine", "type_seniorite"]
SHOW = ["id", "title", "nom_entreprise", "ville", "salary"]


@query("b1_project_rename", "select p_partkey as id_competence, p_name as skill, p_type as type from part")
def b1(t: Tables):
    return t("part").select(F.col("p_partkey").alias("id_competence"), F.col("p_name").alias("skill"),
                            F.col("p_type").alias("type"))


@query("b2_day_slice", """
    select id_offre, id_local from raw_offers where cast(date_extraction as date) = date '2024-01-15'""")
def b2(t: Tables):
    return s.day_slice(t.bind("raw_offers"), "date_extraction", "2024-01-15").select("id_offre", "id_local")


def _filtered(t, *filters):
    return t.bind("search_offers").filter(s.build_predicate([s.Filter(*f) for f in filters])).select(*SHOW)


@query("b3_filter_eq_neq", f"""
    select {', '.join(SHOW)} from search_offers where type_contrat = 'F' and region <> 'ASIA'""")
def b3a(t: Tables):
    return _filtered(t, ("type_contrat", "eq", "F"), ("region", "neq", "ASIA"))


@query("b3_filter_ranges", f"""
    select {', '.join(SHOW)} from search_offers where salary > 1000 and salary <= 200000 and created >= date '1996-01-01' and created < date '1999-06-30'""")
def b3b(t: Tables):
    return _filtered(t, ("salary", "gt", 1000), ("salary", "lte", 200000), ("created", "gte", date(1996, 1, 1)), ("created", "lt", date(1999, 6, 30)))


@query("b3_filter_like_in_between", f"""
    select {', '.join(SHOW)} from search_offers where lower(nom_domaine) like '%hold%'
      and ville in ('NATION_3', 'NATION_7', 'NATION_11') and salary between 50000 and 300000""")
def b3c(t: Tables):
    return _filtered(t, ("nom_domaine", "like", "HOLD"), ("ville", "in", ["NATION_3", "NATION_7", "NATION_11"]),
                     ("salary", "between", [50000, 300000]))


@query("b3_two_filters_one_field", f"""
    select {', '.join(SHOW)} from search_offers where salary > 100000 and salary < 120000""")
def b3d(t: Tables):
    return _filtered(t, ("salary", "gt", 100000), ("salary", "lt", 120000))


def _text_sql(like, columns=TEXT):
    return " or ".join(f"lower({c}) like '{like}'" for c in columns)


@query("b4_free_text", f"select {', '.join(SHOW)} from search_offers where {_text_sql('%ring%')}")
def b4(t: Tables):
    return t.bind("search_offers").filter(s.free_text(TEXT, "Ring")).select(*SHOW)


@query("b4_free_text_wildcards", f"select {', '.join(SHOW)} from search_offers where {_text_sql('%r_d%g%')}")
def b4w(t: Tables):
    return t.bind("search_offers").filter(s.free_text(TEXT, "r_d%g", wildcards=True)).select(*SHOW)


STAGES = [
    s.TermStage(["urgent", "high", "machinery"], ["title", "nom_domaine", "competences", "ville"]),
    s.TermStage(["small", "medium", "m"], ["title", "type_seniorite"]),
    s.TermStage(["f", "o"], ["type_contrat"]),
    s.TermStage([], ["nom_domaine"]),
]


def _stages_sql(distinct: bool) -> str:
    def cond(term, columns):
        return "(" + " or ".join(f"coalesce(lower({c}) like '%' || {term} || '%', false)" for c in columns) + ")"

    names = ["a", "b", "c"]
    frm = "search_offers" + "".join(
        f" cross join (select unnest([{', '.join(repr(x) for x in st.terms)}]) as {n}) as t{n}"
        for n, st in zip(names, STAGES))
    where = " and ".join(cond(n, st.columns) for n, st in zip(names, STAGES))
    cols = ", ".join(SHOW)
    return (f"select {'distinct ' if distinct else ''}{cols} from {frm} where {where} "
            "and lower(concat_ws(', ', ville, region)) like '%nation_1%'")


@query("b5_multi_term_search", _stages_sql(False))
def b5(t: Tables):
    return s.multi_term_search(t.bind("search_offers"), STAGES, "NATION_1", ["ville", "region"]).select(*SHOW)


@query("b5_multi_term_distinct", _stages_sql(True))
def b5d(t: Tables):
    return s.multi_term_search(t.bind("search_offers"), STAGES, "NATION_1", ["ville", "region"],
                               one_row_per_term=False).select(*SHOW)


@query("b6_optional_condition", "select c_custkey, c_name from customer where case when 'build' is not null then lower(c_mktsegment) like '%build%' else true end")
def b6(t: Tables):
    out = s.multi_term_search(t("customer"), [s.TermStage(["build"], ["c_mktsegment"]), s.TermStage([], ["c_name"])])
    return out.select("c_custkey", "c_name")


@query("b7_point_lookup", """
    select user_id, event_id, event_type from events where user_id = 41 order by event_id desc limit 1""")
def b7(t: Tables):
    return s.lookup(t("events"), "user_id", 41, newest="event_id").select("user_id", "event_id", "event_type")


@query("b8_drop_blank", """
    with x as (select doc_id, case lang when 'de' then ' ' when 'es' then null else lang end as lang, source from documents)
    select doc_id from x where (lang is null or lang <> ' ') and (source is null or source <> ' ')""")
def b8(t: Tables):
    x = t("documents").withColumn("lang", F.when(F.col("lang") == "de", " ").when(F.col("lang") != "es", F.col("lang")))
    return s.drop_blank(x, ["lang", "source"]).select("doc_id")


@query("b9_drop_all_null", """
    select doc_id from documents left join labels using (doc_id) where quality is not null or toxic is not null""")
def b9(t: Tables):
    return t("documents").join(t("labels"), "doc_id", "left").dropna(how="all", subset=["quality", "toxic"]).select("doc_id")


@query("b10_semi_top_n", """
    select c_custkey, c_nationkey from customer where c_nationkey in (
      select c_nationkey from customer group by 1 order by count(*) desc, 1 limit 5)""")
def b10(t: Tables):
    return s.semi_top_n(t("customer"), "c_nationkey", 5).select("c_custkey", "c_nationkey")


@query("b11_not_null_coordinates", "select id_local, latitude, longitude from located_offers where latitude is not null and longitude is not null")
def b11(t: Tables):
    return t.bind("located_offers").filter("latitude is not null and longitude is not null").select("id_local", "latitude", "longitude")


@query("b12_boolean_filter", "select doc_id, toxic = 1 as flagged from labels where toxic = 1")
def b12(t: Tables):
    return t("labels").select("doc_id", (F.col("toxic") == 1).alias("flagged")).filter("flagged")


@query("f1_multi_key_sort", """
    select id, ville, salary from search_offers order by ville asc nulls last, salary desc nulls last, id desc""")
def f1(t: Tables):
    return t.bind("search_offers").orderBy(*s.sort_columns([("ville", "asc"), ("salary", "desc")])).select("id", "ville", "salary")


REQUEST = s.SearchRequest([s.Filter("type_contrat", "eq", "O")], "ring", [("salary", "desc")], page=2, size=15)


@query("f2_page", f"""
    select {', '.join(SHOW)} from search_offers where type_contrat = 'O' and ({_text_sql('%ring%')})
    order by salary desc nulls last, id desc limit 15 offset 15""")
def f2(t: Tables):
    return s.search(t.bind("search_offers"), REQUEST, TEXT)[0].select(*SHOW)


@query("f2_page_after", "select id, title from search_offers where id < 700 order by id desc limit 25")
def f2k(t: Tables):
    return s.page_after(t.bind("search_offers"), 700, 25).select("id", "title")


@query("f3_page_envelope", f"""
    with c as (select count(*) as total from search_offers where type_contrat = 'O' and ({_text_sql('%ring%')}))
    select total, cast(2 as bigint) as page, cast(15 as bigint) as page_size, cast(ceil(total / 15) as bigint) as pages,
           2 < ceil(total / 15) as has_next, true as has_prev from c""")
def f3(t: Tables):
    return s.search(t.bind("search_offers"), REQUEST, TEXT)[1]


@query("f4_listing_whole", "select id_competence, skill, type from dim_skill order by id_competence")
def f4(t: Tables):
    return s.listing(t.bind("dim_skill"), "id_competence")


@query("f4_listing_page", "select id_competence, skill, type from dim_skill order by id_competence limit 20 offset 40")
def f4p(t: Tables):
    return s.listing(t.bind("dim_skill"), "id_competence", 3, 20)


@query("f5_top_n_by_count", "select c_mktsegment, count(*) as n from customer group by 1 order by n desc, 1 limit 3")
def f5(t: Tables):
    return s.top_values(t("customer"), "c_mktsegment", 3)


@query("f7_first_rows", "select o_orderkey, o_totalprice from orders order by o_orderkey limit 100")
def f7(t: Tables):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(100)


@query("d17_filtered_count", "select count(*) as total from search_offers where salary > 100000 and region = 'EUROPE'")
def d17(t: Tables):
    hits = t.bind("search_offers").filter(s.build_predicate([s.Filter("salary", "gt", 100000), s.Filter("region", "eq", "EUROPE")]))
    return hits.agg(F.count("*").alias("total"))


@query("h21_in_list", "select p_partkey, p_name from part where p_name in ('red widget', 'blue, bolt', 'hot gear')")
def h21(t: Tables):
    return t("part").filter(s.one_filter(s.Filter("p_name", "in", ["red widget", "blue, bolt", "hot gear"]))).select("p_partkey", "p_name")


@query("h24_coerced_parameters", "select o_orderkey from orders where o_totalprice >= 250000.5 and o_orderstatus = 'O'")
def h24(t: Tables):
    conds = [s.Filter("o_totalprice", "gte", s.coerce("250000.5")), s.Filter("o_orderstatus", "eq", s.coerce("O"))]
    return t("orders").filter(s.build_predicate(conds)).select("o_orderkey")
