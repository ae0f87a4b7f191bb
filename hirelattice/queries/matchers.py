"""Matchers of section C: labels, skills, places, companies, domains."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.operators import rule_data as rd
from hirelattice.operators.companies import company_match
from hirelattice.operators.dictionary import dictionary_match
from hirelattice.operators.domains import domain_match, scored_matches, token_matches, total_tokens
from hirelattice.operators.places import place_match
from hirelattice.operators.rules import rule_match
from hirelattice.plans.bindings import CONTRACTS, REMOTE_MODES, SENIORITIES, values_sql
from hirelattice.queries import Tables, query

# rules made of words that do occur in the given texts
CORPUS_LABELS = [(1, "en"), (2, "fr"), (3, "de"), (4, "es"), (5, "autre")]
CORPUS_RULES = rd.RuleSet("langues", "description", (
    rd.Rule("romance", ("fr", "es"), {"description": (" que ", " por "), "sector": ("src1",)}),
    rd.Rule("germanic", ("en", "de"), {"description": (" the ", " und "), "sector": ("src2",)}),
    rd.Rule("any", ("autre", "en"), {"description": ("tion", "heit")}),
))


def _rules_sql(dim: str, label: str, id_column: str, rules: rd.RuleSet) -> str:
    """The matcher as an OR join and a ranking window."""
    text = f"lower(d.{label})"

    def quoted(k):
        return "'" + k.replace("'", "''") + "'"

    def found(field, words):
        return " or ".join(f"contains(lower(o.{field}), {w})" for w in words)

    flags = [f"contains(lower(o.{rules.exact_field}), {text})", f"contains(lower(o.{rules.partial_field}), {text})"]
    for r in rules.rules:
        labels = ", ".join(quoted(x) for x in r.labels)
        clause = " or ".join(found(f, [quoted(k) for k in words]) for f, words in r.keywords.items())
        flags.append(f"{text} in ({labels}) and ({clause})")
    order = ", ".join(f"coalesce({f}, false) desc" for f in flags)
    return f"""
        select o.id_offre, o.id_local, cast(d.{id_column} as bigint) as {id_column}
        from offers o left join {dim} d on {' or '.join(f'coalesce({f}, false)' for f in flags)}
        qualify row_number() over (partition by o.id_local order by {order}, d.{id_column} nulls last) = 1"""


def _matched(t: Tables, labels, rules, id_column):
    return rule_match(t.bind("offers"), labels, rules, id_column).select("id_offre", "id_local", id_column)


@query("c8_contract_match", _rules_sql("dim_contract", "type_contrat", "id_contrat", rd.CONTRACT_RULES))
def c8(t: Tables):
    return _matched(t, CONTRACTS, rd.CONTRACT_RULES, "id_contrat")


@query("c8_rule_match_corpus", _rules_sql(f"({values_sql(CORPUS_LABELS, 'id_label, label')})", "label", "id_label", CORPUS_RULES))
def c8c(t: Tables):
    return _matched(t, CORPUS_LABELS, CORPUS_RULES, "id_label")


@query("c9_seniority_match", _rules_sql("dim_seniority", "type_seniorite", "id_seniorite", rd.SENIORITY_RULES))
def c9(t: Tables):
    return _matched(t, SENIORITIES, rd.SENIORITY_RULES, "id_seniorite")


@query("c10_remote_match", _rules_sql("dim_remote", "type_teletravail", "id_teletravail", rd.REMOTE_RULES))
def c10(t: Tables):
    return _matched(t, REMOTE_MODES, rd.REMOTE_RULES, "id_teletravail")


@query("c7_skill_match", """
    select distinct o.id_local, c.id_competence, c.skill from offers o join skill_labels c
    on contains(lower(o.description), ' ' || c.skill || ' ') or contains(lower(o.sector), ' ' || c.skill || ' ')""")
def c7(t: Tables):
    return dictionary_match(t.bind("offers"), t.bind("skill_labels"), "skill", ["description", "sector"], ["id_local"])


PLACE_SQL = """
    with o as (select *, lower(location_name) as loc,
                      nullif(regexp_extract(location_name, '([0-9]{2})', 1), '') as code from located_offers),
    p as (select *, substr(cast(code_postal as varchar), 1, 2) as pcode from places),
    j as (select o.id_offre, o.id_local, p.id_lieu, p.population,
            12742 * asin(sqrt(power(sin((radians(o.latitude) - radians(p.latitude)) / 2), 2)
              + cos(radians(p.latitude)) * cos(radians(o.latitude))
                * power(sin((radians(o.longitude) - radians(p.longitude)) / 2), 2))) as km,
            coalesce(contains(o.loc, lower(p.ville)), false) as f_name, coalesce(o.code = p.pcode, false) as f_code,
            coalesce(contains(o.loc, lower(p.departement)), false) as f_dept,
            coalesce(contains(o.loc, lower(p.region)), false) as f_region,
            coalesce(contains(o.loc, lower(p.pays)), false) as f_country
          from o cross join p),
    m as (select *, coalesce(km < 10, false) as f_coord from j
          where coalesce(km < 10, false) or f_name or f_code or f_dept or f_region or f_country),
    best as (select id_offre, id_lieu from m qualify row_number() over (partition by id_offre order by
          f_coord desc, km asc nulls last, f_name desc, f_code desc, f_dept desc, f_region desc, f_country desc,
          population desc nulls last, id_lieu) = 1)
    select o.id_offre, o.id_local, b.id_lieu from located_offers o left join best b on o.id_offre = b.id_offre"""


@query("c11_place_match", PLACE_SQL)
def c11(t: Tables):
    return place_match(t.bind("located_offers"), t.bind("places")).select("id_offre", "id_local", "id_lieu")


@query("c12_company_match", """
    with o as (select *, lower(company_name) as n, lower(split_part(trim(company_name), ' ', 1)) as w from company_offers),
    c as (select *, lower(nom_entreprise) as n, lower(split_part(trim(nom_entreprise), ' ', 1)) as w,
            case categorie_entreprise when 'GE' then 1 when 'ETI' then 2 when 'PME' then 3 else 4 end as prio from companies)
    select o.id_offre, o.id_local, c.siren as id_entreprise, c.nom_entreprise
    from o left join c on o.n = c.n or o.w = c.w
    qualify row_number() over (partition by o.id_local order by coalesce(o.n = c.n, false) desc,
        coalesce(o.w = c.w, false) desc, c.prio, c.siren) = 1""")
def c12(t: Tables):
    return company_match(t.bind("company_offers"), t.bind("companies")).select(
        "id_offre", "id_local", "id_entreprise", "nom_entreprise")


def _tokens_cte(name: str, source: str, id_column: str, text: str) -> str:
    return f"""{name} as (select {id_column}, token from (select {id_column},
        trim(unnest(string_split(regexp_replace(lower({text}), '[-'',.,"]+', ' ', 'g'), ' '))) as token from {source})
        where length(token) > 2 and token not in (select word from stopwords))"""


def _scored_ctes(prefix: str, text: str) -> str:
    return f"""{_tokens_cte(prefix + '_t', 'domain_offers', 'id_local', text)},
    {prefix}_m as (select d.id_domaine, t.id_local, count(*) as matched_tokens,
        count(distinct t.token) as unique_matched_tokens, string_agg(distinct t.token, ' ' order by t.token) as matching_tokens
        from d_t d left join {prefix}_t t on d.token = t.token group by d.id_domaine, t.id_local),
    {prefix}_n as (select id_local, count(distinct token) as total_tokens from {prefix}_t group by id_local),
    {prefix}_s as (select m.*, n.total_tokens, m.unique_matched_tokens * cast(100.0 as double) / n.total_tokens as pct,
        o.{text} as body from {prefix}_m m left join {prefix}_n n on m.id_local = n.id_local
        left join domain_offers o on m.id_local = o.id_local)"""


DOMAIN_TOKENS = _tokens_cte("d_t", "domains", "id_domaine", "nom_domaine")


@query("c14_token_left_join", f"""
    with {DOMAIN_TOKENS}, {_scored_ctes('x', 'description')}
    select id_domaine, count(*) as n_groups, cast(sum(matched_tokens) as bigint) as n_rows,
           count(id_local) as n_offers from x_m group by id_domaine""")
def c14(t: Tables):
    m = token_matches(t.bind("domains"), t.bind("domain_offers"), "description", t.bind("stopwords"))
    return m.groupBy("id_domaine").agg(F.count("*").alias("n_groups"), F.sum("matched_tokens").alias("n_rows"),
                                       F.count("id_local").alias("n_offers"))


@query("d3_token_match_counts", f"""
    with {DOMAIN_TOKENS}, {_scored_ctes('x', 'description')}
    select id_domaine, id_local, matched_tokens, unique_matched_tokens, matching_tokens from x_m""")
def d3(t: Tables):
    return token_matches(t.bind("domains"), t.bind("domain_offers"), "description", t.bind("stopwords")).select(
        "id_domaine", "id_local", F.col("matched_tokens").cast("bigint").alias("matched_tokens"),
        "unique_matched_tokens", "matching_tokens")


@query("d4_distinct_tokens", f"with {_tokens_cte('x', 'domain_offers', 'id_local', 'description')} "
       "select id_local, count(distinct token) as total_tokens from x group by id_local")
def d4(t: Tables):
    return total_tokens(t.bind("domain_offers"), "description", t.bind("stopwords"))


@query("d5_match_percentage", f"""
    with {DOMAIN_TOKENS}, {_scored_ctes('x', 'sector')}
    select id_domaine, id_local, round(pct, 6) as pct from x_s""")
def d5(t: Tables):
    s = scored_matches(t.bind("domains"), t.bind("domain_offers"), "sector", t.bind("stopwords"))
    return s.select("id_domaine", "id_local", F.round("pct", 6).alias("pct"))


DOMAIN_SQL = f"""
    with {DOMAIN_TOKENS}, {_scored_ctes('a', 'sector')}, {_scored_ctes('b', 'description')},
    pairs as (select a.id_domaine, a.body as sector, b.body as description, a.id_local,
        coalesce(a.pct, 0) * cast(0.6 as double) + coalesce(b.pct, 0) * cast(0.4 as double) as score, b.id_domaine as other
        from a_s a full join b_s b on a.id_local = b.id_local),
    c1 as (select id_domaine, sector, id_local from pairs
        qualify row_number() over (partition by coalesce(sector, 'NULL_SECTOR'), id_local
                                   order by score desc, id_domaine nulls last, other nulls last) = 1),
    c2 as (select id_domaine, null as sector, id_local from
        (select *, row_number() over (partition by body order by pct desc nulls last, id_local, id_domaine) as r from b_s)
        where r = 1 and body is not null and id_local not in (select id_local from pairs where sector is not null)),
    c3 as (select id_domaine, body as sector, id_local from
        (select *, row_number() over (partition by body order by pct desc nulls last, id_local, id_domaine) as r from a_s)
        where r = 1 and body is not null and id_local not in (select id_local from pairs where description is not null))
    select c.id_domaine, d.nom_domaine, c.sector, c.id_local
    from (select * from c1 union all select * from c2 union all select * from c3) c
    left join domains d on c.id_domaine = d.id_domaine"""


@query("k34_domain_match", DOMAIN_SQL)
def k34(t: Tables):
    return domain_match(t.bind("domain_offers"), t.bind("domains"), t.bind("stopwords"))


@query("k34_domain_match_per_domain", f"""
    with {DOMAIN_TOKENS}, {_scored_ctes('a', 'sector')}, {_scored_ctes('b', 'description')},
    x as (select * from a_s where id_local is not null), y as (select * from b_s where id_local is not null),
    m as (select coalesce(x.id_local, y.id_local) as id_local, coalesce(x.id_domaine, y.id_domaine) as id_domaine,
        coalesce(x.pct, 0) * cast(0.6 as double) + coalesce(y.pct, 0) * cast(0.4 as double) as score
        from x full join y on x.id_local = y.id_local and x.id_domaine = y.id_domaine),
    best as (select * from m qualify row_number() over (partition by id_local order by score desc, id_domaine) = 1)
    select b.id_domaine, d.nom_domaine, o.sector, b.id_local
    from best b join domains d using (id_domaine) join domain_offers o using (id_local)""")
def k34p(t: Tables):
    return domain_match(t.bind("domain_offers"), t.bind("domains"), t.bind("stopwords"), mode="per_domain")
