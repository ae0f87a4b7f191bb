"""Section C: equi joins, the fact, the bridges, anti joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.functions.calendar import calendar, date_parts
from hirelattice.operators import candidates as cand
from hirelattice.operators import rule_data as rd
from hirelattice.operators import star
from hirelattice.operators.companies import company_match
from hirelattice.operators.dates import date_match
from hirelattice.operators.dictionary import dictionary_match
from hirelattice.operators.rules import rule_match
from hirelattice.operators.tokens import not_in
from hirelattice.plans.bindings import CONTRACTS, REMOTE_MODES, SENIORITIES
from hirelattice.queries import Tables, query
from hirelattice.queries.matchers import _rules_sql
from hirelattice.sources.readers import parse_id_arrays


@query("c1_assemble_fact", f"""
    with a as ({_rules_sql('dim_contract', 'type_contrat', 'id_contrat', rd.CONTRACT_RULES)}),
    b as ({_rules_sql('dim_seniority', 'type_seniorite', 'id_seniorite', rd.SENIORITY_RULES)}),
    c as ({_rules_sql('dim_remote', 'type_teletravail', 'id_teletravail', rd.REMOTE_RULES)})
    select o.id_local, a.id_contrat, b.id_seniorite, c.id_teletravail, l.quality
    from offers o left join a on o.id_local = a.id_local left join b on o.id_local = b.id_local
    left join c on o.id_local = c.id_local left join labels l on o.id_offre = l.doc_id""")
def c1(t: Tables):
    o = t.bind("offers")
    matches = [
        rule_match(o, CONTRACTS, rd.CONTRACT_RULES, "id_contrat").select("id_local", "id_contrat"),
        rule_match(o, SENIORITIES, rd.SENIORITY_RULES, "id_seniorite").select("id_local", "id_seniorite"),
        rule_match(o, REMOTE_MODES, rd.REMOTE_RULES, "id_teletravail").select("id_local", "id_teletravail"),
        t("labels").select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id_local"), "quality"),
    ]
    return star.assemble_fact(o.select("id_local"), matches)


def _day_sql(d: str, suffix: str) -> str:
    months = "['janvier','février','mars','avril','mai','juin','juillet','août','septembre','octobre','novembre','décembre']"
    days = "['dimanche','lundi','mardi','mercredi','jeudi','vendredi','samedi']"
    return (f"month({d}) as mois_{suffix}, day({d}) as jour_{suffix}, {months}[month({d})] as mois_nom_{suffix}, "
            f"{days}[dayofweek({d}) + 1] as jour_semaine_{suffix}, dayofweek({d}) in (0, 6) as week_end_{suffix}")


WIDE_SQL = f"""
    with rome as (select f.id_offre, r.id_rome from star_offers f join dim_rome r on lower(f.code_rome) = lower(r.code_rome)),
    sk as (select b.id_offre, string_agg(distinct d.skill, ', ' order by d.skill) as competences,
                  string_agg(distinct d.type, ', ' order by d.type) as types_competences
           from offer_skills b join dim_skill d on b.id_competence = d.id_competence group by 1),
    me as (select r.id_rome, string_agg(distinct m.nom, ', ' order by m.nom) as nom_metier
           from rome_metier_raw x join dim_rome r on lower(x.code_rome) = lower(r.code_rome)
           join dim_metier m on lower(x.libelle) = lower(m.nom) group by 1),
    so as (select r.id_rome, string_agg(distinct s.summary, ', ' order by s.summary) as softskills_summary,
                  string_agg(distinct s.details, ' | ' order by s.details) as softskills_details
           from rome_softskill_raw x join dim_rome r on lower(x.code_rome) = lower(r.code_rome)
           join dim_softskill s on lower(x.summary) = lower(s.summary) group by 1)
    select f.id_offre, f.id_local, f.status, f.salary, f.id_entreprise, c.nom_entreprise, c.categorie, c.ville, c.region,
           rome.id_rome, {_day_sql('f.created', 'creation')}, {_day_sql('(f.created + interval 10 day)', 'modification')},
           sk.competences, sk.types_competences, me.nom_metier, so.softskills_summary, so.softskills_details
    from star_offers f left join dim_company c on f.id_entreprise = c.id_entreprise
    left join rome on f.id_offre = rome.id_offre left join sk on f.id_offre = sk.id_offre
    left join me on rome.id_rome = me.id_rome left join so on rome.id_rome = so.id_rome"""


def _bridges(t: Tables):
    rome = t.bind("dim_rome")
    skills = t.bind("offer_skills").join(t.bind("dim_skill"), "id_competence")
    metier = star.bridge(t.bind("rome_metier_raw"), rome, t.bind("dim_metier"), ("code_rome", "code_rome"),
                         ("libelle", "nom"), "id_rome", "id_metier").join(t.bind("dim_metier"), "id_metier")
    soft = star.bridge(t.bind("rome_softskill_raw"), rome, t.bind("dim_softskill"), ("code_rome", "code_rome"),
                       ("summary", "summary"), "id_rome", "id_softskill").join(t.bind("dim_softskill"), "id_softskill")
    return [
        (skills, "id_offre", {"competences": ("skill", ", "), "types_competences": ("type", ", ")}),
        (metier, "id_rome", {"nom_metier": ("nom", ", ")}),
        (soft, "id_rome", {"softskills_summary": ("summary", ", "), "softskills_details": ("details", " | ")}),
    ]


def _wide(t: Tables, naive: bool = False):
    least, most = t.bind("star_offers").agg(F.min("created"), F.date_add(F.max("created"), 10)).first()
    days = calendar(t.spark, str(least or "1900-01-01")[:10], str(most or "1900-01-01")[:10]).drop("semestre")
    parts = [c for c in days.columns if c != "id_date"]

    def role(suffix):
        return days.select(F.col("id_date").alias(f"id_date_{suffix}"), *[F.col(c).alias(f"{c}_{suffix}") for c in parts])

    # codes are matched by their lower case; a code that is not listed has no id
    fact = t.bind("star_offers").withColumns({
        "_code": F.lower("code_rome"), "id_date_creation": F.col("created"), "id_date_modification": F.date_add("created", 10)})
    rome = t.bind("dim_rome").select(F.lower("code_rome").alias("_code"), "id_rome")
    wide = star.wide_table(
        fact.drop("code_rome", "created"),
        [(rome, "_code"), (role("creation"), "id_date_creation"), (role("modification"), "id_date_modification"),
         (t.bind("dim_company"), "id_entreprise")], _bridges(t), naive)
    return wide.drop("_code", "id_date_creation", "id_date_modification")


@query("d1_wide_table", WIDE_SQL)
def d1(t: Tables):
    return _wide(t)


@query("c2_role_playing_dates", f"""
    select id_offre, {_day_sql('created', 'creation')}, {_day_sql('(created + interval 10 day)', 'modification')} from star_offers""")
def c2(t: Tables):
    return _wide(t).select("id_offre", *[f"{c}_{s}" for s in ("creation", "modification")
                                         for c in ("mois", "jour", "mois_nom", "jour_semaine", "week_end")])


@query("c3_code_join_ignoring_case", """
    select f.id_local, r.id_rome from star_offers f join dim_rome r on lower(f.code_rome) = lower(r.code_rome)""")
def c3(t: Tables):
    return star.code_match(t.bind("star_offers"), t.bind("dim_rome"), "code_rome", "code_rome", ["id_local"], "id_rome")


@query("c4_bridge_rome_metier", """
    select distinct r.id_rome, m.id_metier from rome_metier_raw x join dim_rome r on lower(x.code_rome) = lower(r.code_rome)
    join dim_metier m on lower(x.libelle) = lower(m.nom)""")
def c4(t: Tables):
    return star.bridge(t.bind("rome_metier_raw"), t.bind("dim_rome"), t.bind("dim_metier"), ("code_rome", "code_rome"),
                       ("libelle", "nom"), "id_rome", "id_metier")


@query("c5_bridge_rome_softskill", """
    select distinct r.id_rome, s.id_softskill from rome_softskill_raw x join dim_rome r on lower(x.code_rome) = lower(r.code_rome)
    join dim_softskill s on lower(x.summary) = lower(s.summary)""")
def c5(t: Tables):
    return star.bridge(t.bind("rome_softskill_raw"), t.bind("dim_rome"), t.bind("dim_softskill"), ("code_rome", "code_rome"),
                       ("summary", "summary"), "id_rome", "id_softskill")


@query("c6_bridge_offer_skill", """
    with m as (select distinct o.id_local, c.id_competence from offers o join skill_labels c
               on contains(lower(o.description), ' ' || c.skill || ' ')),
    f as (select id_local, id_offre from offers o join labels l on o.id_offre = l.doc_id)
    select f.id_offre, m.id_competence from m left join f on m.id_local = f.id_local""")
def c6(t: Tables):
    o = t.bind("offers")
    match = dictionary_match(o, t.bind("skill_labels"), "skill", ["description"], ["id_local"])
    fact = o.join(t("labels"), o.id_offre == F.col("doc_id"), "left_semi")
    return star.offer_bridge(match, fact, "id_offre", "id_competence")


@query("c13_date_match", """
    with o as (select * from dated_offers qualify row_number() over (
                 partition by id_local order by date_created desc nulls last, id_offre) = 1)
    select id_offre, id_local,
           strftime(case when cast(date_created as date) between date '1995-01-01' and date '2002-12-31'
                then cast(date_created as date) else date '1900-01-01' end, '%Y-%m-%d') as id_date_created,
           strftime(case when cast(date_updated as date) between date '1995-01-01' and date '2002-12-31'
                then cast(date_updated as date) else date '1900-01-01' end, '%Y-%m-%d') as id_date_updated from o""")
def c13(t: Tables):
    out = date_match(t.bind("dated_offers"), calendar(t.spark, "1995-01-01", "2002-12-31"))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("id_date_created", "id_date_updated")})


@query("c15_full_outer_join", """
    select coalesce(d.doc_id, l.doc_id) as doc_id, d.n_chars, l.quality from (select * from documents where lang = 'en') d
    full join (select * from labels where quality = 1) l on d.doc_id = l.doc_id""")
def c15(t: Tables):
    d = t("documents").filter("lang = 'en'").select("doc_id", "n_chars")
    return d.join(t("labels").filter("quality = 1").select("doc_id", "quality"), "doc_id", "full")


@query("c16_not_in", """
    select d.doc_id from documents d where d.doc_id not in (select doc_id from labels where toxic = 0)""")
def c16(t: Tables):
    return not_in(t("documents").select("doc_id"), "doc_id", t("labels").filter("toxic = 0"), "doc_id")


@query("c16_not_in_with_null", """
    select count(*) as n from documents d where d.doc_id not in (select case when toxic = 0 then doc_id end from labels)""")
def c16n(t: Tables):
    others = t("labels").select(F.when(F.col("toxic") == 0, F.col("doc_id")).alias("doc_id"))
    return not_in(t("documents").select("doc_id"), "doc_id", others, "doc_id").agg(F.count("*").alias("n"))


@query("c17_insert_if_absent", """
    select distinct p_name as name from part where not exists (select 1 from benchmark b where b.text = p_name)""")
def c17(t: Tables):
    return t("part").select(F.col("p_name").alias("name")).join(
        t("benchmark").select(F.col("text").alias("name")), "name", "left_anti").distinct()


@query("c18_insert_by_name", """
    select o.o_orderkey, c.c_custkey as id_entreprise from orders o left join customer c
    on c.c_name = 'Customer#' || lpad(cast(o.o_custkey + 100 as varchar), 9, '0')""")
def c18(t: Tables):
    named = t("orders").select("o_orderkey", F.concat(F.lit("Customer#"), F.lpad((F.col("o_custkey") + 100).cast("string"), 9, "0")).alias("c_name"))
    return named.join(t("customer").select("c_name", F.col("c_custkey").alias("id_entreprise")), "c_name", "left").drop("c_name")


@query("c19_parameter_list", """
    select p.p_partkey, x.term from part p cross join (select unnest(['red', 'bolt', 'ring']) as term) x where contains(p.p_name, x.term)""")
def c19(t: Tables):
    terms = F.array(*map(F.lit, ["red", "bolt", "ring"]))
    return t("part").select("p_partkey", F.explode(F.filter(terms, lambda x: F.contains(F.col("p_name"), x))).alias("term"))


@query("c20_outer_unnest", """
    with x as (select doc_id, case when lang = 'fr' then string_split(source, 'r') else [] end as a from documents)
    select x.doc_id, u.v as piece from x left join (select doc_id, unnest(a) as v from x) u on x.doc_id = u.doc_id""")
def c20(t: Tables):
    pieces = F.when(F.col("lang") == "fr", F.split("source", "r")).otherwise(F.array().cast("array<string>"))
    return t("documents").select("doc_id", F.explode_outer(pieces).alias("piece"))


@query("c21_softskills_of_code", """
    select distinct s.id_softskill, s.summary from rome_softskill_raw x join dim_softskill s on x.summary = s.summary
    where x.code_rome = '2-HIGH'""")
def c21(t: Tables):
    # case matters here, unlike in the bridge
    raw = t.bind("rome_softskill_raw").filter(F.col("code_rome") == "2-HIGH").select("summary").distinct()
    return t.bind("dim_softskill").join(raw, "summary").select("id_softskill", "summary")


@query("c22_merge_drop_unmatched", "select d.doc_id, l.quality from documents d join labels l on d.doc_id = l.doc_id")
def c22(t: Tables):
    return t("documents").select("doc_id").join(t("labels").select("doc_id", "quality"), "doc_id")


@query("c23_join_for_counts", """
    select n.n_name, count(*) as n from supplier s join nation n on s.s_nationkey = n.n_nationkey group by 1""")
def c23(t: Tables):
    # count per key first, then name the key
    counts = t("supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return counts.join(t("nation").select("n_nationkey", "n_name"), "n_nationkey").select("n_name", "n")


def _candidates(t: Tables):
    return parse_id_arrays(t.bind("raw_candidates"), ["skill_ids", "place_ids"])


CANDIDATE_TEXT_SQL = """
    with s as (select id_candidat, cast(unnest(cast(cast(skill_ids as json) as bigint[])) as bigint) as id from raw_candidates),
    p as (select id_candidat, cast(unnest(cast(cast(place_ids as json) as bigint[])) as bigint) as id from raw_candidates),
    st as (select id_candidat, string_agg(distinct p_name || ' ' || p_type, ' ' order by p_name || ' ' || p_type) as x
           from s join part on id = p_partkey group by 1),
    pt as (select id_candidat, string_agg(distinct n_name || ' area', ' ' order by n_name || ' area') as x
           from p join nation on id = n_nationkey group by 1)
    select c.id_candidat, c.nom, coalesce(st.x, '') || ' ' || coalesce(pt.x, '') as text
    from raw_candidates c left join st on c.id_candidat = st.id_candidat left join pt on c.id_candidat = pt.id_candidat"""


def _candidate_dims(t: Tables):
    return [("skill_ids", t("part"), "p_partkey", F.concat_ws(" ", "p_name", "p_type")),
            ("place_ids", t("nation"), "n_nationkey", F.concat(F.col("n_name"), F.lit(" area")))]


@query("c24_candidate_labels", """
    with s as (select id_candidat, cast(unnest(cast(cast(skill_ids as json) as bigint[])) as bigint) as id from raw_candidates)
    select distinct s.id_candidat, p.p_name || ' ' || p.p_type as label from s left join part p on s.id = p.p_partkey""")
def c24(t: Tables):
    ids = _candidates(t).select("id_candidat", F.explode("skill_ids").alias("p_partkey"))
    labels = t("part").select("p_partkey", F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")).alias("label"))
    return ids.join(labels, "p_partkey", "left").select("id_candidat", "label").distinct()


@query("c25_candidate_texts", CANDIDATE_TEXT_SQL)
def c25(t: Tables):
    return cand.candidate_text(_candidates(t), _candidate_dims(t))


@query("k33_candidate_text", CANDIDATE_TEXT_SQL)
def k33(t: Tables):
    return cand.candidate_text(_candidates(t), _candidate_dims(t))


@query("d7_array_to_text", """
    select o_custkey as id_candidat, string_agg(distinct o_orderpriority, ' ' order by o_orderpriority) as text from orders group by 1""")
def d7(t: Tables):
    return star.join_values(t("orders").withColumnRenamed("o_custkey", "id_candidat"), ["id_candidat"], {"text": ("o_orderpriority", " ")})


@query("h20_flatten_arrays", """
    with a as (select id_candidat, nom, cast(cast(skill_ids as json) as bigint[]) as s, cast(cast(place_ids as json) as bigint[]) as p from raw_candidates),
    b as (select id_candidat, nom, unnest(case when len(s) = 0 then [null] else s end) as id_competence, p from a)
    select id_candidat, nom, id_competence, unnest(case when len(p) = 0 then [null] else p end) as id_lieu from b""")
def h20(t: Tables):
    out = cand.explode_candidates(_candidates(t), {"skill_ids": "id_competence", "place_ids": "id_lieu"})
    return out.select("id_candidat", "nom", F.col("id_competence").cast("bigint").alias("id_competence"), F.col("id_lieu").cast("bigint").alias("id_lieu"))


@query("c27_candidate_occupation", """
    select c.c_custkey, n.n_name as occupation from customer c left join nation n on c.c_nationkey = n.n_nationkey""")
def c27(t: Tables):
    n = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("occupation"))
    return t("customer").join(n, "c_nationkey", "left").select("c_custkey", "occupation")


@query("h19_calendar", f"""
    select strftime(d, '%Y-%m-%d') as id_date, cast(ceil(month(d) / 6) as bigint) as semestre, {_day_sql('d', 'x')}
    from (select distinct cast(o_orderdate as date) as d from orders)""")
def h19(t: Tables):
    days = date_parts(t("orders").select(F.to_date("o_orderdate").alias("id_date")).distinct(), "id_date")
    renamed = [F.col(c).alias(f"{c}_x") for c in days.columns if c not in ("id_date", "semestre")]
    return days.select(F.date_format("id_date", "yyyy-MM-dd").alias("id_date"), "semestre", *renamed)
