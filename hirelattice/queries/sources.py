"""Section A: sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.operators.dedup import dedup_rank
from hirelattice.queries import Tables, query
from hirelattice.session import run_dir
from hirelattice.sources import feeds, loads, readers

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _orders_csv(t: Tables, **options):
    path = run_dir(t.spark, "orders-csv")
    df = t("orders").select(*ORDER_COLUMNS).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    df.write.options(header="true", **options).csv(path)
    return path, df.schema


ORDERS_SQL = """select o_orderkey, o_custkey, nullif(o_orderstatus, 'P') as o_orderstatus,
    round(o_totalprice, 2) as o_totalprice, o_orderpriority from orders"""


@query("a1_csv_strict", ORDERS_SQL)
def a1(t: Tables):
    path, schema = _orders_csv(t, nullValue=readers.NULL_MARK)
    return readers.read_offers_csv(t.spark, path, schema, "strict")


@query("a2_csv_lenient", ORDERS_SQL)
def a2(t: Tables):
    # nulls written as empty text
    path, schema = _orders_csv(t, nullValue="", emptyValue="")
    return readers.read_offers_csv(t.spark, path, schema, "lenient")


@query("a3_csv_quoted_gzip", "select doc_id as id_offre, text as description, source as secteur from documents")
def a3(t: Tables):
    path = run_dir(t.spark, "documents-csv")
    docs = t("documents").select("doc_id", "text", "source")
    # the fields hold line breaks and quotes
    docs.write.options(header="true", quoteAll="true", escape="\\", compression="gzip", emptyValue="").csv(path)
    df = readers.read_offers_csv(t.spark, path, docs.schema, "quoted", ["id_offre", "description", "secteur"])
    return readers.good_rows(df)


@query("a4_parquet_schema_report", """
    with d as (select cast(row_number() over () as bigint) as position, column_name,
           case when column_type in ('BIGINT', 'INTEGER') then 'NUMBER' when column_type = 'DOUBLE' then 'FLOAT'
                when column_type like 'TIMESTAMP%' then 'TIMESTAMP' else 'VARCHAR' end as type_name
    from (describe lineitem)),
    n as (unpivot (select count(columns(*)) from lineitem) on columns(*) into name column_name value n_known)
    select d.*, n.n_known from d join n using (column_name)""")
def a4(t: Tables):
    return readers.schema_report(t("lineitem"))


@query("a5_discover_columns", """
    with packed as (select to_json({'segment': c_mktsegment, 'balance': c_acctbal, 'nation': c_nationkey,
                           'vip': c_acctbal > 9000}) as j from customer),
    pairs as (select unnest(json_keys(j)) as key, j from packed)
    select key, case json_type(j, '$.' || key) when 'UBIGINT' then 'INTEGER' else json_type(j, '$.' || key) end as type_name,
           count(*) as n_rows from pairs group by all""")
def a5(t: Tables):
    packed = t("customer").select(F.to_json(F.struct(
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"), (F.col("c_acctbal") > 9000).alias("vip"))).alias("j"))
    return readers.discover_columns(packed, "j")


@query("a5_project_discovered", """
    select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def a5b(t: Tables):
    return readers.project_discovered(t("events"), "props", {"k": "bigint"}, ["event_id"])


@query("a6_latest_drop", """
    select o_orderkey, o_totalprice from orders
    where o_orderstatus <> 'P' and strftime(o_orderdate, '%Y%m') = (select strftime(max(o_orderdate), '%Y%m') from orders where o_orderstatus <> 'P')""")
def a6(t: Tables):
    # one delivery per month; orders of status P come in one without a readable date
    folder = run_dir(t.spark, "drops")
    month = F.concat(F.lit("all_jobs_"), F.date_format("o_orderdate", "yyyyMM"), F.lit("01_0844_offers"))
    rows = t("orders").select("o_orderkey", "o_totalprice",
                              F.when(F.col("o_orderstatus") == "P", "all_jobs_undated").otherwise(month).alias("delivery"))
    rows.repartition("delivery").write.partitionBy("delivery").options(header="true", compression="gzip", nullValue=readers.NULL_MARK).csv(folder)
    paths = readers.latest_drop(t.spark, folder)
    return readers.read_offers_csv(t.spark, paths, rows.drop("delivery").schema, "strict")


def _feed_one(t: Tables):
    """The orders as landed nested JSON of the first feed."""
    path = run_dir(t.spark, "feed-one")
    o, c = t("orders"), t("customer")
    (o.join(c, o.o_custkey == c.c_custkey).select(F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("c_mktsegment")).alias("description"),
        F.struct(F.col("c_name").alias("display_name")).alias("company"),
        F.struct(F.col("c_mktsegment").alias("display_name")).alias("location"),
        F.col("o_orderstatus").alias("contract_type"), F.col("o_totalprice").alias("salary_min"),
        F.when(F.col("o_orderstatus") == "P", "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("created"),
    )).alias("value")).write.text(path))
    return t.spark.read.schema(feeds.FEED_ONE).json(path)


def _feed_two(t: Tables):
    """The customers as landed nested JSON of the second feed."""
    path = run_dir(t.spark, "feed-two")
    c, n = t("customer"), t("nation")
    (c.join(n, c.c_nationkey == n.n_nationkey).select(F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("intitule"),
        F.col("c_mktsegment").alias("description"), F.struct(F.col("n_name").alias("libelle")).alias("lieuTravail"),
        F.when(F.col("c_acctbal") > 0, F.struct(F.col("c_name").alias("nom"))).alias("entreprise"),
        F.lit("2024-05-01T10:00:00.000Z").alias("dateCreation"),
    )).alias("value")).write.text(path))
    return t.spark.read.schema(feeds.FEED_TWO).json(path)


EXTRACTED = "2024-06-01 00:00:00"


def _one(t):
    return feeds.normalize_source(_feed_one(t), feeds.PATHS_ONE, "feed_one", F.lit(EXTRACTED))


def _two(t):
    return feeds.normalize_source(_feed_two(t), feeds.PATHS_TWO, "feed_two", F.lit(EXTRACTED))


def _shown(df):
    fmt = "yyyy-MM-dd HH:mm:ss"
    return df.withColumns({c: F.date_format(c, fmt) for c in ("date_created", "date_extraction")})


ONE_SQL = f"""
    select cast(o_orderkey as varchar) as id, 'feed_one' as source, o_orderpriority as title,
           case when o_orderstatus <> 'F' then c_mktsegment end as description, c_name as company_name,
           c_mktsegment as location_name, o_orderstatus as contract_type, o_totalprice as salary_min,
           cast(null as double) as salary_max, cast(null as varchar) as application_url,
           case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as date_created,
           '{EXTRACTED}' as date_extraction
    from orders join customer on o_custkey = c_custkey"""
TWO_SQL = f"""
    select cast(c_custkey as varchar) as id, 'feed_two' as source, c_name as title, c_mktsegment as description,
           case when c_acctbal > 0 then c_name end as company_name, n_name as location_name,
           cast(null as varchar) as contract_type, cast(null as double) as salary_min, cast(null as double) as salary_max,
           cast(null as varchar) as application_url, '2024-05-01 10:00:00' as date_created, '{EXTRACTED}' as date_extraction
    from customer join nation on c_nationkey = n_nationkey"""


@query("a7_normalize_feed_one", ONE_SQL)
def a7(t: Tables):
    return _shown(_one(t))


@query("a8_normalize_feed_two", TWO_SQL)
def a8(t: Tables):
    return _shown(_two(t))


@query("a9_blank_to_null", """
    select l_linestatus, count(*) as n, count(nullif(case when l_returnflag = 'N' then '' else l_returnflag end, '')) as n_text
    from lineitem group by l_linestatus""")
def a9(t: Tables):
    text = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag"))
    return t("lineitem").groupBy("l_linestatus").agg(
        F.count("*").alias("n"), F.count(feeds.blank_to_null(text)).alias("n_text"))


@query("a10_append_with_id", """
    select (select max(c_custkey) from customer) + row_number() over (order by s_name, s_suppkey) as c_custkey,
           s_name as c_name, s_nationkey as c_nationkey, s_acctbal as c_acctbal, cast(null as varchar) as c_mktsegment
    from supplier""")
def a10(t: Tables):
    # the batch arrives as text
    batch = t("supplier").select(
        F.col("s_name").alias("c_name"), F.col("s_nationkey").cast("string").alias("c_nationkey"),
        F.col("s_acctbal").cast("string").alias("c_acctbal"))
    return loads.append_with_id(t("customer"), batch, "c_custkey", ["c_name", "c_nationkey", "c_acctbal"])


@query("a11_stage_then_append", """
    select 'customer' as origin, c_name as name, c_nationkey as nation from customer
    union all select 'supplier', s_name, s_nationkey from supplier""")
def a11(t: Tables):
    path = run_dir(t.spark, "stage-append")
    t("customer").select(F.lit("customer").alias("origin"), F.col("c_name").alias("name"),
                         F.col("c_nationkey").alias("nation")).write.parquet(path)
    t("supplier").select(F.lit("supplier").alias("origin"), F.col("s_name").alias("name"),
                         F.col("s_nationkey").alias("nation")).write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query("a12_load_once", "select n_nationkey, n_name, n_regionkey from nation")
def a12(t: Tables):
    path = run_dir(t.spark, "load-once")
    loads.load_once(t.spark, path, t("nation"))
    # the second load finds rows and leaves them
    loads.load_once(t.spark, path, t("nation"))
    return t.spark.read.parquet(path)


@query("a13_truncate_reload", "select s_suppkey, s_name from supplier")
def a13(t: Tables):
    path = run_dir(t.spark, "reload")
    loads.reload(t("supplier").select("s_suppkey", "s_name").filter("s_acctbal < 0"), path)
    loads.reload(t("supplier").select("s_suppkey", "s_name"), path)
    return t.spark.read.parquet(path)


@query("a14_export_gzip_csv", "select c_custkey, c_name, c_acctbal from customer")
def a14(t: Tables):
    path = run_dir(t.spark, "export")
    df = t("customer").select("c_custkey", "c_name", "c_acctbal")
    loads.export_csv_gz(df, path)
    return t.spark.read.schema(df.schema).options(header="true", quote='"').csv(path)


@query("a15_export_semicolon", "select p_partkey, p_name, p_retailprice from part")
def a15(t: Tables):
    path = run_dir(t.spark, "export-semicolon")
    df = t("part").select("p_partkey", "p_name", "p_retailprice")
    loads.export_csv_gz(df, path, sep=";")
    return t.spark.read.schema(df.schema).options(header="true", sep=";").csv(path)


@query("a16_concat_feeds", """
    select c_name as name, c_acctbal as balance, c_mktsegment as segment, cast(null as integer) as nation from customer
    union all select s_name, s_acctbal, null, s_nationkey from supplier""")
def a16(t: Tables):
    return feeds.unite(
        t("customer").selectExpr("c_name as name", "c_acctbal as balance", "c_mktsegment as segment"),
        t("supplier").selectExpr("s_name as name", "s_acctbal as balance", "s_nationkey as nation"))


_MANIFEST = ("region", "nation", "supplier", "customer", "part")


@query("a17_load_manifest", " union all ".join(
    f"select '{layer}' as layer, '{n}' as table_name, true as written, (select count(*) from {n}) as n_rows"
    for n in _MANIFEST for layer in ("raw", "silver")))
def a17(t: Tables):
    return loads.load_manifest(t.spark, {n: t.path(n) for n in _MANIFEST}, run_dir(t.spark, "manifest"), ("raw", "silver"))


@query("a17_load_manifest_csv", """
    select 'raw' as layer, 'region' as table_name, true as written, (select count(*) from region) as n_rows
    union all select 'raw', 'nation', true, (select count(*) from nation)
    union all select 'raw', 'customer', true, (select count(*) from customer)""")
def a17c(t: Tables):
    # a manifest of both kinds: each delimited source has its schema and dialect, the other one is Parquet
    sources = {"region": t.path("region")}
    for name, dialect, written in (("nation", "lenient", {"compression": "gzip"}), ("customer", "quoted", {"quoteAll": "true", "escape": "\\"})):
        path = run_dir(t.spark, f"{name}-csv")
        t(name).write.options(header="true", emptyValue="", **written).csv(path)
        sources[name] = loads.CsvSource(path, t(name).schema, dialect)
    return loads.load_manifest(t.spark, sources, run_dir(t.spark, "manifest"), ("raw",))


@query("a18_json_id_arrays", """
    select id_candidat, len(cast(skill_ids as json[])) as n_skills,
           list_sum(cast(cast(skill_ids as json) as bigint[])) :: bigint as sum_skills,
           len(cast(place_ids as json[])) as n_places
    from raw_candidates""")
def a18(t: Tables):
    c = readers.parse_id_arrays(t.bind("raw_candidates"), ["skill_ids", "place_ids"])
    total = F.aggregate("skill_ids", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return c.select("id_candidat", F.size("skill_ids").cast("bigint").alias("n_skills"),
                    F.when(F.size("skill_ids") > 0, total).alias("sum_skills"),
                    F.size("place_ids").cast("bigint").alias("n_places"))


@query("g5_union_feeds", f"{ONE_SQL} union all {TWO_SQL}")
def g5(t: Tables):
    return _shown(feeds.unite(_one(t), _two(t)))


@query("g3_keep_first_across_feeds", """
    with fed as (select cast(user_id as varchar) as id, event_type as source, event_id as feed_order, value from events)
    select id, source, feed_order, value from fed
    qualify row_number() over (partition by source, id order by feed_order) = 1""")
def g3(t: Tables):
    fed = t("events").selectExpr("cast(user_id as string) as id", "event_type as source", "event_id as feed_order", "value")
    return dedup_rank(fed, ["source", "id"], ["feed_order"])


@query("h18_parse_iso_timestamps", """
    select o_orderkey, case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m-%d') end as day from orders""")
def h18(t: Tables):
    text = F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t("orders").select("o_orderkey", F.date_format(F.to_date(feeds.iso_timestamp(text)), "yyyy-MM-dd").alias("day"))
