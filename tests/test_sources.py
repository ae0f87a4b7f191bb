import pytest
from pyspark.sql import functions as F

from conftest import rows
from hirelattice.session import run_dir
from hirelattice.sources import feeds, loads, readers


def _text(spark, name, lines):
    path = run_dir(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_strict_refuses_a_short_row(spark):
    path = _text(spark, "strict", ["id,name", "1,a", "2"])
    schema = spark.createDataFrame([], "id int, name string").schema
    with pytest.raises(Exception):
        readers.read_offers_csv(spark, path, schema, "strict").collect()


def test_lenient_keeps_it_and_nulls_empty_text(spark):
    path = _text(spark, "lenient", ["id,name", '1,""', "2", r"3,\N", "4,x", "5,NULL", "6,null", "NULL,Null"])
    schema = spark.createDataFrame([], "id int, name string").schema
    got = {tuple(r) for r in readers.read_offers_csv(spark, path, schema, "lenient").collect()}
    assert got == {(1, None), (2, None), (3, None), (4, "x"), (5, None), (6, None), (None, "Null")}


def test_latest_drop_and_unreadable_names(spark):
    base = run_dir(spark, "drops")
    for name in ("all_jobs_20250101_0800_x", "all_jobs_20250609_0844_y", "all_jobs_zzz"):
        spark.range(1).select(F.lit(name).alias("n")).coalesce(1).write.option("header", "true").csv(f"{base}/{name}")
    paths = readers.latest_drop(spark, base)
    assert paths and all("20250609_0844" in p for p in paths)


def test_id_arrays(spark):
    df = spark.createDataFrame([("[1, 2]",), ("[]",), (None,)], "a string")
    assert [r[0] for r in readers.parse_id_arrays(df, ["a"]).collect()] == [[1, 2], [], None]


def test_bad_dates_do_not_fail(spark):
    df = spark.createDataFrame([("2024-05-01T10:00:00Z",), ("2024-05-01T10:00:00.000Z",), ("soon",), (None,)], "t string")
    got = [r[0] for r in df.select(F.date_format(feeds.iso_timestamp(F.col("t")), "yyyy-MM-dd HH")).collect()]
    assert got == ["2024-05-01 10", "2024-05-01 10", None, None]


def test_feeds_unite_in_canonical_columns(spark):
    one = spark.createDataFrame([('{"id":"1","title":"","company":{"display_name":"c"},"created":"x"}',)], "j string")
    two = spark.createDataFrame([('{"id":"1","intitule":"t","entreprise":{"nom":"n"}}',)], "j string")
    at = F.lit("2024-01-01 00:00:00")
    a = feeds.normalize_source(one.select(F.from_json("j", feeds.FEED_ONE).alias("s")).select("s.*"), feeds.PATHS_ONE, "one", at)
    b = feeds.normalize_source(two.select(F.from_json("j", feeds.FEED_TWO).alias("s")).select("s.*"), feeds.PATHS_TWO, "two", at)
    both = feeds.unite(a, b)
    assert both.columns == list(feeds.CANONICAL)
    assert rows(both.select("source", "title", "company_name", "salary_min")) == [("one", None, "c", None), ("two", "t", "n", None)]


def test_load_once_and_append_ids(spark):
    path = run_dir(spark, "once")
    df = spark.createDataFrame([(7, "a")], "id long, name string")
    assert loads.load_once(spark, path, df) and not loads.load_once(spark, path, df)
    batch = spark.createDataFrame([("c",), ("b",)], "name string")
    assert rows(loads.append_with_id(df, batch, "id", ["name"])) == [(8, "b"), (9, "c")]


def test_discovered_types(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":2,"c":{"d":1}}',)], "j string")
    assert rows(readers.discover_columns(df, "j")) == [("a", "INTEGER", 2), ("b", "VARCHAR", 1), ("c", "OBJECT", 1)]
