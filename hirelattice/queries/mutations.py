"""Section J: mutations and incremental maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.operators import upsert as u
from hirelattice.operators.bucketed import BucketedTable
from hirelattice.operators.dedup import dedup_rank
from hirelattice.queries import Tables, query
from hirelattice.session import run_dir

# the target: what was known before mid-month; the batch: what came after
SPLIT = "2024-01-16"


def _halves(t: Tables):
    raw = t.bind("raw_offers")
    old, new = raw.filter(F.col("date_extraction") < SPLIT), raw.filter(F.col("date_extraction") >= SPLIT)
    latest = [F.col("id_offre").desc()]
    return dedup_rank(old, ["id_local"], latest), new, latest


HALVES = f"""o as (select * from raw_offers where date_extraction < timestamp '{SPLIT} 00:00:00'
      qualify row_number() over (partition by id_local order by id_offre desc) = 1),
    n as (select * from raw_offers where date_extraction >= timestamp '{SPLIT} 00:00:00'
      qualify row_number() over (partition by id_local order by id_offre desc) = 1)"""


@query("j1_upsert_fact", f"""with {HALVES}
    select id_local, id_offre, contract_type from n union all
    select id_local, id_offre, contract_type from o where id_local not in (select id_local from n)""")
def j1(t: Tables):
    old, new, latest = _halves(t)
    table = BucketedTable(t.spark, run_dir(t.spark, "fact"), ["id_local"], buckets=8)
    table.replace(old.select("id_local", "id_offre", "contract_type"))
    table.upsert(new.select("id_local", "id_offre", "contract_type"), order=latest)
    return table.read()


@query("j1_upsert_twice", f"""with {HALVES}
    select id_local, id_offre, contract_type from n union all
    select id_local, id_offre, contract_type from o where id_local not in (select id_local from n)""")
def j1t(t: Tables):
    # a day that is run again, an empty change, and the older versions gone
    old, new, latest = _halves(t)
    names = ["id_local", "id_offre", "contract_type"]
    table = BucketedTable(t.spark, run_dir(t.spark, "fact"), ["id_local"], buckets=8)
    table.replace(old.select(*names))
    table.upsert(new.select(*names), order=latest)
    first = table.read()
    table.upsert(new.select(*names), order=latest)
    table.upsert(first.limit(0))
    table.vacuum(keep=1)
    return table.read()


@query("j2_upsert_wide", """
    select c_custkey as id, c_name as title, case when s_suppkey is not null then 'both' else c_mktsegment end as description
    from customer left join supplier on c_custkey = s_suppkey""")
def j2(t: Tables):
    wide = t("customer").selectExpr("c_custkey as id", "c_name as title", "c_mktsegment as description")
    ids = t("supplier").selectExpr("s_suppkey as id")
    batch = wide.join(ids, "id", "left_semi").withColumn("description", F.lit("both"))
    table = BucketedTable(t.spark, run_dir(t.spark, "wide"), ["id"], buckets=8)
    table.replace(wide)
    table.upsert(batch)
    return table.read()


@query("j3_upsert_composite_key", """
    with o as (select distinct l_orderkey, l_partkey, 'old' as origin from lineitem where l_returnflag <> 'A'),
    n as (select distinct l_orderkey, l_partkey, 'new' as origin from lineitem where l_linestatus = 'F')
    select * from n union all select o.* from o anti join n on o.l_orderkey = n.l_orderkey and o.l_partkey = n.l_partkey""")
def j3(t: Tables):
    li = t("lineitem")
    old = li.filter("l_returnflag <> 'A'").select("l_orderkey", "l_partkey").distinct().withColumn("origin", F.lit("old"))
    new = li.filter("l_linestatus = 'F'").select("l_orderkey", "l_partkey").distinct().withColumn("origin", F.lit("new"))
    table = BucketedTable(t.spark, run_dir(t.spark, "bridge"), ["l_orderkey", "l_partkey"], buckets=8)
    table.replace(old)
    table.upsert(new)
    return table.read()


def _schema_batches(t: Tables):
    target = t("customer").select("c_custkey", "c_name", "c_acctbal")
    batch = t("supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("nation"))
    return target, batch


@query("j4_append_new_columns", """
    select s_suppkey as c_custkey, s_name as c_name, cast(null as double) as c_acctbal, s_nationkey as nation from supplier
    union all select c_custkey, c_name, c_acctbal, null from customer where c_custkey not in (select s_suppkey from supplier)""")
def j4(t: Tables):
    target, batch = _schema_batches(t)
    return u.upsert(target, batch, ["c_custkey"], "append_new")


@query("j5_sync_all_columns", """
    select s_suppkey as c_custkey, s_name as c_name, s_nationkey as nation from supplier
    union all select c_custkey, c_name, null from customer where c_custkey not in (select s_suppkey from supplier)""")
def j5(t: Tables):
    target, batch = _schema_batches(t)
    return u.upsert(target, batch, ["c_custkey"], "sync_all")


@query("j6_bulk_insert", """
    select c_custkey as id, c_name as title, c_acctbal as salary from customer
    union all select s_suppkey + 1000000, s_name, null from supplier""")
def j6(t: Tables):
    target = t("customer").selectExpr("c_custkey as id", "c_name as title", "c_acctbal as salary")
    return u.insert(target, t("supplier").selectExpr("s_suppkey + 1000000 as id", "s_name as title"))


CHANGES = "select s_suppkey as id, case when s_acctbal > 2000 then s_name end as title, s_acctbal as salary from supplier"


def _target_and_changes(t: Tables):
    target = t("customer").selectExpr("c_custkey as id", "c_name as title", "c_acctbal as salary", "c_mktsegment as nom_domaine")
    changes = t("supplier").selectExpr("s_suppkey as id", "case when s_acctbal > 2000 then s_name end as title", "s_acctbal as salary")
    return target, changes


@query("j7_bulk_update", f"""
    select c.c_custkey as id, case when x.id is not null then x.title else c.c_name end as title,
           case when x.id is not null then x.salary else c.c_acctbal end as salary, c.c_mktsegment as nom_domaine
    from customer c left join ({CHANGES}) x on c.c_custkey = x.id""")
def j7(t: Tables):
    return u.update(*_target_and_changes(t), "id")


@query("j8_bulk_patch", f"""
    select c.c_custkey as id, coalesce(x.title, c.c_name) as title, coalesce(x.salary, c.c_acctbal) as salary, c.c_mktsegment as nom_domaine
    from customer c left join ({CHANGES}) x on c.c_custkey = x.id""")
def j8(t: Tables):
    return u.patch(*_target_and_changes(t), "id")


@query("j9_bulk_delete", "select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def j9(t: Tables):
    gone = t("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return u.delete_by(t("orders").select("o_orderkey", "o_custkey"), gone, ["o_orderkey"])


@query("j10_not_found", "select distinct o_custkey as c_custkey from orders where o_custkey not in (select s_suppkey from supplier)")
def j10(t: Tables):
    held = t("supplier").select(F.col("s_suppkey").alias("c_custkey"))
    return u.not_found(held, t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
