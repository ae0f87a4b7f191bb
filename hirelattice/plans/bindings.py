"""How the given tables stand in for offers, dimensions, bridges and candidates.

Each relation is a plain projection or join of whole given tables, written in SQL that both
Spark and the checking database read. Missing attributes are derived from keys, so that every
row takes part.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# The small label dimensions.
CONTRACTS = [(1, "CDI"), (2, "CDD"), (3, "Intérim"), (4, "Stage"), (5, "Freelance"), (6, "Alternance")]
SENIORITIES = [(1, "Junior"), (2, "Confirmé"), (3, "Senior")]
REMOTE_MODES = [(1, "À distance"), (2, "Sur site"), (3, "Hybride")]


def values_sql(rows: list[tuple], columns: str) -> str:
    def lit(v):
        return "null" if v is None else str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) as t({columns})"


BINDINGS: dict[str, str] = {
    # every extraction of an offer: several rows per local id
    "raw_offers": """
        select event_id as id_offre, concat('L', cast(user_id as string)) as id_local,
               event_type as contract_type, value as salary, cast(ts as timestamp) as date_extraction
        from events""",
    # one row per offer with its texts
    "offers": """
        select d.doc_id as id_offre, concat('D', cast(d.doc_id as string)) as id_local,
               d.text as description, d.source as sector, d.lang as langues,
               case when d.n_chars < 400 then 'Contrat CDI' when d.n_chars < 900 then 'cdd'
                    when d.n_chars < 1500 then 'FREELANCE' when d.n_chars < 2500 then 'Intérim'
                    when d.n_chars < 4000 then 'autre' end as contract_type,
               case when l.toxic = 1 then 'franchise' when l.toxic = 0 then 'Contrat à durée indéterminée' end
                   as contract_duration,
               case when l.quality = 1 then 'Expérience exigée' when l.quality = 0 then 'Débutant accepté' end
                   as experience_required
        from documents d left join labels l on d.doc_id = l.doc_id""",
    "dim_contract": values_sql(CONTRACTS, "id_contrat, type_contrat"),
    "dim_seniority": values_sql(SENIORITIES, "id_seniorite, type_seniorite"),
    "dim_remote": values_sql(REMOTE_MODES, "id_teletravail, type_teletravail"),
    # offers with a place: customers; text of several kinds, some without coordinates or text
    "located_offers": """
        select c.c_custkey as id_offre, concat('C', cast(c.c_custkey as string)) as id_local,
               case c.c_mktsegment
                    when 'BUILDING' then concat('Ville ', n.n_name)
                    when 'MACHINERY' then concat('75 - ', cast(c.c_custkey as string))
                    when 'HOUSEHOLD' then concat('Secteur ', r.r_name)
                    when 'FURNITURE' then 'Partout en France' end as location_name,
               case when c.c_acctbal < 5000 then cast(4200 + (c.c_custkey * 37) % 900 as double) / 100 end as latitude,
               case when c.c_acctbal < 5000 then cast((c.c_custkey * 91) % 1200 - 400 as double) / 100 end as longitude
        from customer c join nation n on c.c_nationkey = n.n_nationkey
        join region r on n.n_regionkey = r.r_regionkey""",
    "places": """
        select s.s_suppkey as id_lieu, cast((s.s_suppkey * 731) % 95000 + 1000 as bigint) as code_postal,
               n.n_name as ville, concat('Dep ', n.n_name) as departement, r.r_name as region,
               case when r.r_name = 'ASIA' then 'Asie' else 'France' end as pays,
               case when s.s_acctbal < 8000 then cast(4200 + (s.s_suppkey * 53) % 900 as double) / 100 end as latitude,
               case when s.s_acctbal < 8000 then cast((s.s_suppkey * 77) % 1200 - 400 as double) / 100 end as longitude,
               case when s.s_acctbal > 0 then cast(floor(s.s_acctbal) as bigint) end as population
        from supplier s join nation n on s.s_nationkey = n.n_nationkey
        join region r on n.n_regionkey = r.r_regionkey""",
    # offers with a company name, and the company register
    "company_offers": """
        select p_partkey as id_offre, concat('P', cast(p_partkey as string)) as id_local,
               case p_type when 'PROMO' then concat('  ', p_name) when 'ECONOMY' then upper(p_name)
                    when 'SMALL' then concat(p_brand, ' ', p_name) when 'LARGE' then null
                    else p_name end as company_name
        from part""",
    "companies": """
        select p_partkey as siren,
               case p_type when 'PROMO' then concat(p_name, ' sa') when 'SMALL' then concat(p_brand, ' ', p_name)
                    when 'LARGE' then null when 'MEDIUM' then concat(' ', p_name) else p_name end as nom_entreprise,
               case p_type when 'ECONOMY' then 'GE' when 'STANDARD' then 'ETI' when 'PROMO' then 'PME' end
                   as categorie_entreprise
        from part""",
    # offers with a creation and an update date
    "dated_offers": """
        select o_orderkey as id_offre, concat('C', cast(o_custkey as string)) as id_local,
               cast(o_orderdate as timestamp) as date_created,
               case when o_orderstatus = 'F' then cast(o_orderdate as timestamp) end as date_updated
        from orders""",
    # the star: offer = order, skills = parts of the order, occupation code = order priority
    "star_offers": """
        select o_orderkey as id_offre, concat('O', cast(o_orderkey as string)) as id_local,
               o_custkey as id_entreprise, o_orderpriority as code_rome, o_orderstatus as status,
               o_totalprice as salary, cast(o_orderdate as date) as created
        from orders""",
    "offer_skills": "select distinct l_orderkey as id_offre, l_partkey as id_competence from lineitem",
    "dim_skill": "select p_partkey as id_competence, p_name as skill, p_type as type from part",
    "dim_company": """
        select c.c_custkey as id_entreprise, c.c_name as nom_entreprise, c.c_mktsegment as categorie,
               n.n_name as ville, r.r_name as region
        from customer c join nation n on c.c_nationkey = n.n_nationkey
        join region r on n.n_regionkey = r.r_regionkey""",
    # occupation codes and what hangs on them
    "dim_rome": """
        select cast(r_regionkey as bigint) + 1 as id_rome,
               case r_regionkey when 0 then '1-urgent' when 1 then '2-HIGH' when 2 then '3-Medium'
                    when 3 then '4-NOT SPECIFIED' else '5-low' end as code_rome
        from region""",
    "rome_metier_raw": """
        select case n_regionkey when 0 then '1-URGENT' when 1 then '2-HIGH' when 2 then '3-MEDIUM'
                    when 3 then '4-not specified' else '5-LOW' end as code_rome,
               n_name as libelle
        from nation""",
    "dim_metier": "select n_nationkey as id_metier, n_name as nom from nation",
    "rome_softskill_raw": """
        select case p_type when 'PROMO' then '1-URGENT' when 'ECONOMY' then '2-HIGH' when 'STANDARD' then '3-MEDIUM'
                    when 'SMALL' then '4-NOT SPECIFIED' else '5-LOW' end as code_rome,
               p_brand as summary, concat('about ', p_brand) as details, p_retailprice as score
        from part""",
    "dim_softskill": """
        select distinct cast(substr(p_brand, 7) as bigint) as id_softskill, p_brand as summary,
               concat('about ', p_brand) as details
        from part""",
    # domains: the benchmark items are the labels' texts
    "domains": "select item_id as id_domaine, text as nom_domaine from benchmark",
    # offers whose sector text is shared by several offers
    "domain_offers": """
        select c.conv_id * 1000 + c.turn as id_offre, concat('T', cast(c.conv_id * 1000 + c.turn as string)) as id_local,
               case when role = 'assistant' then null else c.text end as description,
               case when role = 'system' then null else b.text end as sector
        from conversations c left join benchmark b on c.conv_id = b.item_id""",
    # an offer table to search in
    "search_offers": """
        select o.o_orderkey as id, o.o_orderpriority as title, c.c_name as nom_entreprise, c.c_mktsegment as nom_domaine,
               n.n_name as ville, r.r_name as region, o.o_orderstatus as type_contrat, o.o_totalprice as salary,
               cast(o.o_orderdate as date) as created, p.p_name as competences, p.p_type as type_seniorite,
               p.p_brand as description
        from orders o join customer c on o.o_custkey = c.c_custkey
        join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
        left join part p on o.o_orderkey = p.p_partkey""",
    "vectors": "select vec_id as id, embedding as vec, label from embeddings",
}

# Relations that need list functions differ by dialect: (Spark, checking database).
DIALECT_BINDINGS: dict[str, tuple[str, str]] = {
    # skill labels of one and two words taken from the benchmark texts
    "skill_labels": (
        """select cast(conv(left(md5(skill), 12), 16, 10) as bigint) as id_competence, skill from (
             select distinct skill from (
               select explode(split(lower(text), ' ')) as skill from benchmark
               union all
               select concat(w[p], ' ', w[p + 1]) as skill from (
                 select split(lower(text), ' ') as w, posexplode(split(lower(text), ' ')) as (p, x) from benchmark)
               where p + 1 < size(w)) where length(skill) > 2)""",
        """select cast('0x' || left(md5(skill), 12) as bigint) as id_competence, skill from (
             select distinct skill from (
               select unnest(string_split(lower(text), ' ')) as skill from benchmark
               union all
               select w[p] || ' ' || w[p + 1] as skill from (
                 select string_split(lower(text), ' ') as w,
                        unnest(range(1, len(string_split(lower(text), ' ')))) as p from benchmark)
               ) where length(skill) > 2)""",
    ),
    # stop words by rule: tokens held by a fifth or more of the benchmark texts
    "stopwords": (
        """select word from (select item_id, explode(array_distinct(split(regexp_replace(lower(text), '[-\\',.,"]+', ' '), ' '))) as word
             from benchmark) group by word having count(*) * 5 >= (select count(*) from benchmark)""",
        """select word from (select item_id, unnest(list_distinct(string_split(regexp_replace(lower(text), '[-'',.,"]+', ' ', 'g'), ' '))) as word
             from benchmark) group by word having count(*) * 5 >= (select count(*) from benchmark)""",
    ),
    # candidates: ids as JSON text arrays, one array per dimension
    "raw_candidates": (
        """select c.c_custkey as id_candidat, c.c_name as nom,
                  coalesce(s.a, '[]') as skill_ids, coalesce(s.b, '[]') as place_ids
           from customer c left join (
             select o_custkey, concat('[', array_join(sort_array(collect_set(o_orderkey % 50)), ', '), ']') as a,
                    case when count(*) > 8 then concat('[', array_join(sort_array(collect_set(o_orderkey % 7)), ', '), ']') end as b
             from orders group by o_custkey) s on c.c_custkey = s.o_custkey""",
        """select c.c_custkey as id_candidat, c.c_name as nom,
                  coalesce(s.a, '[]') as skill_ids, coalesce(s.b, '[]') as place_ids
           from customer c left join (
             select o_custkey, '[' || array_to_string(list_sort(list(distinct o_orderkey % 50)), ', ') || ']' as a,
                    case when count(*) > 8 then '[' || array_to_string(list_sort(list(distinct o_orderkey % 7)), ', ') || ']' end as b
             from orders group by o_custkey) s on c.c_custkey = s.o_custkey""",
    ),
}


def _text(name: str, dialect: int) -> str:
    return BINDINGS[name] if name in BINDINGS else DIALECT_BINDINGS[name][dialect]


def _names(sql: str, pool) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [n for n in pool if n in words]


def spark_binding(tables, name: str) -> DataFrame:
    """The bound relation as a DataFrame over the whole given tables."""
    sql = _text(name, 0)
    views = {}
    for base in _names(sql, BASE):
        views[base] = tables(base)
        sql = re.sub(rf"\b(from|join)\s+{base}\b", rf"\1 {{{base}}}", sql)
    return tables.spark.sql(sql, **views) if views else tables.spark.sql(sql)


def duck_with(sql: str) -> str:
    """Put the bound relations that ``sql`` names in front of it as CTEs."""
    pool = [*BINDINGS, *DIALECT_BINDINGS]
    used = [n for n in _names(sql, pool) if re.search(rf"\b(from|join)\s+{n}\b", sql, re.I)]
    if not used:
        return sql
    ctes = ", ".join(f"{n} as ({_text(n, 1)})" for n in used)
    body = sql.strip()
    if body[:5].lower() == "with ":
        return f"with {ctes}, {body[5:]}"
    return f"with {ctes} {body}"
