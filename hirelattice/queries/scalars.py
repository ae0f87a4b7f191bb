"""Section H: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.functions import geo, text as x
from hirelattice.operators.companies import first_word
from hirelattice.operators.places import department_code
from hirelattice.queries import Tables, query


@query("h1_string_basics", """
    select c_custkey, lower(trim(c_name)) as low, length(c_mktsegment) as n, c_name || ' ' || nullif(c_mktsegment, 'BUILDING') as both from customer""")
def h1(t: Tables):
    return t("customer").select("c_custkey", F.lower(F.trim("c_name")).alias("low"), F.length("c_mktsegment").cast("bigint").alias("n"),
                                F.concat("c_name", F.lit(" "), F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("both"))


@query("h2_concat_ws_address", """
    select id_lieu, concat_ws(', ', ville, cast(code_postal as varchar), departement, nullif(region, 'ASIA'), pays) as address from places""")
def h2(t: Tables):
    return t.bind("places").select("id_lieu", F.concat_ws(", ", "ville", F.col("code_postal").cast("string"), "departement",
                                                          F.nullif("region", F.lit("ASIA")), "pays").alias("address"))


@query("h3_contains_like", """
    select p_partkey, contains(lower(p_name), 'ring') as has_ring, p_name like 're_ %' as red_like from part""")
def h3(t: Tables):
    return t("part").select("p_partkey", F.contains(F.lower("p_name"), F.lit("ring")).alias("has_ring"), F.col("p_name").like("re_ %").alias("red_like"))


@query("h4_first_word", "select id_offre, lower(split_part(trim(company_name), ' ', 1)) as word from company_offers")
def h4(t: Tables):
    return t.bind("company_offers").select("id_offre", first_word(F.col("company_name")).alias("word"))


@query("h5_separators_to_blank", """
    select doc_id, regexp_replace(lower(text), '[-'',.,"]+', ' ', 'g') as plain from documents""")
def h5(t: Tables):
    return t("documents").select("doc_id", F.regexp_replace(F.lower("text"), "[-',.,\"]+", " ").alias("plain"))


@query("h6_department_code", "select id_offre, nullif(regexp_extract(location_name, '([0-9]{2})', 1), '') as code from located_offers")
def h6(t: Tables):
    return t.bind("located_offers").select("id_offre", department_code(F.col("location_name")).alias("code"))


@query("h7_first_three", "select n_nationkey, case when length(n) >= 3 then left(n, 3) end as code from (select n_nationkey, substr(n_name, 8) || r as n from (select *, case when n_regionkey > 2 then 'xy' else '' end as r from nation))")
def h7(t: Tables):
    code = F.concat(F.expr("substr(n_name, 8)"), F.when(F.col("n_regionkey") > 2, "xy").otherwise(""))
    return t("nation").select("n_nationkey", x.first_three(code).alias("code"))


@query("h8_reduce_title", r"""
    select p_partkey, regexp_replace(replace(p_name, ' ', ' / ') || ' en chef', '([^\s/]+) / ([^\s/]+)(.*)', '\1\3', 'g') as title from part""")
def h8(t: Tables):
    return t("part").select("p_partkey", x.reduce_title(F.concat(F.regexp_replace("p_name", " ", " / "), F.lit(" en chef"))).alias("title"))


@query("h9_concat_codes", "select l_orderkey, l_linenumber, l_suppkey, cast(l_orderkey as varchar) || cast(l_linenumber as varchar) || l_returnflag as code from lineitem")
def h9(t: Tables):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                F.concat(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), "l_returnflag").alias("code"))


@query("h10_shorten", "select doc_id, case when length(text) > 500 then left(text, 500) || '...' else text end as short from documents")
def h10(t: Tables):
    return t("documents").select("doc_id", x.shorten(F.col("text")).alias("short"))


@query("h11_strip_accents", "select doc_id, strip_accents(text) as plain from documents")
def h11(t: Tables):
    return t("documents").select("doc_id", x.strip_accents(F.col("text")).alias("plain"))


@query("h12_clean_v1", r"select doc_id, trim(regexp_replace(lower(text), '[^a-zÀ-ÿ]+', ' ', 'g')) as clean from documents")
def h12(t: Tables):
    return t("documents").select("doc_id", x.clean_v1(F.col("text")).alias("clean"))


@query("h13_clean_v2", r"""
    select doc_id, regexp_replace(regexp_replace(strip_accents(lower(text)), '[^a-z0-9\s\x{a0}]', ' ', 'g'), '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g') as clean from documents""")
def h13(t: Tables):
    return t("documents").select("doc_id", x.clean_v2(F.col("text")).alias("clean"))


@query("h14_clean_v3", r"select doc_id, trim(regexp_replace(strip_accents(text), '[^a-zA-Z'']+', ' ', 'g')) as clean from documents")
def h14(t: Tables):
    return t("documents").select("doc_id", x.clean_v3(F.col("text")).alias("clean"))


@query("h15_sanitize_csv", r"""
    select page_id, regexp_replace(replace(regexp_replace(html, '\r\n|\n|\r', ' ', 'g'), '"', '""'), '[\x00-\x1f\x7f]', '', 'g') as clean from pages""")
def h15(t: Tables):
    return t("pages").select("page_id", x.sanitize_csv(F.col("html")).alias("clean"))


@query("h16_haversine", """
    select id_offre, round(12742 * asin(sqrt(power(sin((radians(latitude) - radians(48.85)) / 2), 2)
      + cos(radians(48.85)) * cos(radians(latitude)) * power(sin((radians(longitude) - radians(2.35)) / 2), 2))), 6) as km
    from located_offers""")
def h16(t: Tables):
    km = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(48.85), F.lit(2.35))
    return t.bind("located_offers").select("id_offre", F.round(km, 6).alias("km"))


@query("h17_coalesce_nullif_case", """
    select doc_id, coalesce(nullif(source, 'src1'), 'none') as source, case lang when 'fr' then 1 when 'en' then 2 else 3 end as code from documents""")
def h17(t: Tables):
    return t("documents").select("doc_id", F.coalesce(F.nullif("source", F.lit("src1")), F.lit("none")).alias("source"),
                                 F.when(F.col("lang") == "fr", 1).when(F.col("lang") == "en", 2).otherwise(3).alias("code"))


@query("h22_type_of_value", """
    select json_type(props, '$.k') = 'UBIGINT' as is_integer, count(*) as n from events group by 1""")
def h22(t: Tables):
    kind = F.schema_of_variant(F.try_parse_json("props"))
    return t("events").groupBy(kind.contains("k: BIGINT").alias("is_integer")).agg(F.count("*").alias("n"))


@query("h23_joined_text", """
    select id, coalesce(title, '') || '. ' || coalesce(nom_entreprise, '') || '. ' || coalesce(competences, '') || '. ' ||
           coalesce(type_seniorite, '') || '. ' || coalesce(ville, '') as text from search_offers""")
def h23(t: Tables):
    return t.bind("search_offers").select("id", x.joined_text(["title", "nom_entreprise", "competences", "type_seniorite", "ville"]).alias("text"))


@query("h25_round_score", "select l_orderkey, l_linenumber, l_suppkey, l_partkey, round(l_extendedprice / 7919, 3) as score from lineitem")
def h25(t: Tables):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.round(F.col("l_extendedprice") / 7919, 3).alias("score"))
