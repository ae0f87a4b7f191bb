"""Section M: design-stage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.operators import design as d
from hirelattice.queries import Tables, query

# candidates are customers, who know the parts they bought with status F; pairs are their other orders
CTES = """
    known as (select distinct o_custkey as id_candidat, l_partkey as id_competence from orders join lineitem on o_orderkey = l_orderkey where o_orderstatus = 'F'),
    pairs as (select o_custkey as id_candidat, o_orderkey as id_offre from orders where o_orderstatus <> 'F'),
    need as (select distinct l_orderkey as id_offre, l_partkey as id_competence from lineitem),
    teach as (select distinct l_suppkey as id_formation, l_partkey as id_competence from lineitem),
    gap as (select p.*, n.id_competence from pairs p join need n using (id_offre)
            anti join known k on p.id_candidat = k.id_candidat and n.id_competence = k.id_competence)"""


def _inputs(t: Tables):
    skill = F.col("l_partkey").alias("id_competence")
    li, o = t("lineitem"), t("orders")
    need = li.select(F.col("l_orderkey").alias("id_offre"), skill).distinct()
    mine = o.select(F.col("o_custkey").alias("id_candidat"), F.col("o_orderkey").alias("id_offre"), "o_orderstatus")
    known = mine.filter("o_orderstatus = 'F'").join(need, "id_offre").select("id_candidat", "id_competence").distinct()
    pairs = mine.filter("o_orderstatus <> 'F'").select("id_candidat", "id_offre")
    teach = li.select(F.col("l_suppkey").alias("id_formation"), skill).distinct()
    return pairs, need, known, teach


@query("m1_missing_skills", f"with {CTES} select id_candidat, id_offre, id_competence from gap")
def m1(t: Tables):
    pairs, need, known, _ = _inputs(t)
    return d.missing_skills(pairs, need, known)


@query("m2_skill_score", f"""with {CTES}
    select p.id_candidat, p.id_offre, round(count(k.id_competence) / count(*), 6) as score from pairs p join need n using (id_offre)
    left join known k on p.id_candidat = k.id_candidat and n.id_competence = k.id_competence group by 1, 2""")
def m2(t: Tables):
    pairs, need, known, _ = _inputs(t)
    return d.skill_score(pairs, need, known).withColumn("score", F.round("score", 6))


@query("m3_training_suggestion", f"""with {CTES},
    c as (select g.id_candidat, g.id_offre, t.id_formation, count(*) as covered from gap g join teach t using (id_competence) group by 1, 2, 3)
    select *, row_number() over (partition by id_candidat, id_offre order by covered desc, id_formation) as rank from c qualify rank <= 2""")
def m3(t: Tables):
    pairs, need, known, teach = _inputs(t)
    return d.suggest_training(d.missing_skills(pairs, need, known), teach, 2)


@query("m4_skill_weight", """
    with o as (select o_orderkey as id_offre, o_orderpriority as domaine from orders),
    s as (select domaine, count(*) as n from o group by 1)
    select o.domaine, b.id_competence, round(count(*) / any_value(s.n), 8) as weight from offer_skills b join o using (id_offre) join s using (domaine) group by 1, 2""")
def m4(t: Tables):
    offers = t("orders").select(F.col("o_orderkey").alias("id_offre"), F.col("o_orderpriority").alias("domaine"))
    return d.skill_weight(offers, t.bind("offer_skills"), "domaine").withColumn("weight", F.round("weight", 8))


@query("m5_market_trend", """
    with m as (select o_orderpriority as domaine, strftime(o_orderdate, '%Y-%m') as month, count(*) as n, avg(o_totalprice) as mean from orders group by 1, 2)
    select domaine, month, n, round(mean, 4) as mean, n - lag(n) over w as change_n, round(mean - lag(mean) over w, 4) as change_mean
    from m window w as (partition by domaine order by month)""")
def m5(t: Tables):
    offers = t("orders").withColumnRenamed("o_orderpriority", "domaine")
    return d.trend(offers, "domaine", "o_orderdate", "o_totalprice").withColumns({c: F.round(c, 4) for c in ("mean", "change_mean")})


@query("m6_attractiveness", """
    with x as (select o_orderkey, o_totalprice as salary, (o_orderstatus = 'O') :: int as remote, case when o_orderpriority < '4' then length(o_orderpriority) end as contract from orders),
    e as (select min(salary) as a, max(salary) as b, min(contract) as c, max(contract) as d from x)
    select o_orderkey, round(0.5 * (salary - a) / (b - a) + 0.3 * remote + 0.2 * coalesce((contract - c) / (d - c), 0), 6) as score from x, e""")
def m6(t: Tables):
    x = t("orders").select("o_orderkey", F.col("o_totalprice").alias("salary"), (F.col("o_orderstatus") == "O").cast("int").alias("remote"),
                           F.when(F.col("o_orderpriority") < "4", F.length("o_orderpriority")).alias("contract"))
    return d.attractiveness(x, {"salary": 0.5, "remote": 0.3, "contract": 0.2}, "o_orderkey").withColumn("score", F.round("score", 6))
