"""The bucketed table: only touched buckets are written, versions switch at once, changes can come again."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hirelattice.operators.bucketed import BUCKET, BucketedTable, Conflict
from hirelattice.operators.upsert import upsert
from hirelattice.session import run_dir

SCHEMA = "id long, k string, v int"


def make(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def files(table, version):
    return {k: sorted((f, os.stat(os.path.join(table.base, d, f)).st_mtime_ns) for f in os.listdir(os.path.join(table.base, d)))
            for k, d in table.files_of(version).items()}


@pytest.fixture
def table(spark):
    t = BucketedTable(spark, run_dir(spark, "bucketed"), ["id", "k"], buckets=16)
    t.replace(make(spark, [(i, "a", i) for i in range(200)] + [(None, "n", 1)]))
    return t


def test_untouched_buckets_keep_their_files(spark, table):
    before = files(table, 0)
    batch = make(spark, [(3, "a", 100), (3, "b", 7), (500, "a", 1)])
    assert table.upsert(batch) == 1
    want = upsert(table.read(0), batch, ["id", "k"])
    assert rows(table.read()) == rows(want) and table.read().count() == 203
    after = files(table, 1)
    touched = {r[0] for r in batch.select(table._bucket()).collect()}
    assert 0 < len(touched) < len(before)
    assert {k for k in before if after[k] != before[k]} == touched & set(before)
    # the old version can still be read
    assert rows(table.read(0).filter("id = 3")) == [(3, "a", 3)]


def test_two_runs_and_a_failed_one(spark, table, monkeypatch):
    batch = make(spark, [(3, "a", 100), (900, "a", 1)])
    with monkeypatch.context() as m:
        m.setattr(BucketedTable, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.upsert(batch)
    assert table.latest() == 0 and table.read().count() == 201
    broken = make(spark, [(3, "a", 100)]).withColumn("v", F.expr("cast(raise_error('bad row') as int)"))
    with pytest.raises(Exception, match="bad row"):
        table.upsert(broken)
    assert rows(BucketedTable(spark, table.base, ["id", "k"]).read().filter("id = 3")) == [(3, "a", 3)]
    table.upsert(batch)
    once = rows(table.read())
    table.upsert(batch)
    assert rows(table.read()) == once and len(once) == 202


def test_a_change_delivered_again_is_left_out(spark, table):
    assert table.upsert(make(spark, [(1, "a", 50)]), writer=("s", 7)) == 1
    assert table.upsert(make(spark, [(1, "a", 60)]), writer=("s", 7)) == 1
    assert table.upsert(make(spark, [(1, "a", 60)]), writer=("s", 6)) == 1
    assert rows(table.read().filter("id = 1")) == [(1, "a", 50)] and table.applied("s") == 7 and table.applied("other") is None
    assert table.upsert(make(spark, [(1, "a", 70)]), writer=("s", 8)) == 2 and table.upsert(make(spark, [(2, "a", 0)]), writer=("t", 1)) == 3
    assert rows(table.read().filter("id < 3")) == [(0, "a", 0), (1, "a", 70), (2, "a", 0)]


def test_of_two_writers_one_starts_anew(spark, table):
    table.upsert(make(spark, [(1, "a", 50)]), base=0)
    with pytest.raises(Conflict):
        table.upsert(make(spark, [(1, "a", 60)]), base=0)
    assert rows(table.read().filter("id = 1")) == [(1, "a", 50)]


def test_columns_come_and_go(spark, table):
    table.upsert(make(spark, [(1, "a", 5, "new")], SCHEMA + ", w string"))
    assert rows(table.read().filter("id in (1, 2)")) == [(1, "a", 5, "new"), (2, "a", 2, None)]
    table.upsert(make(spark, [(2, "a", "x")], "id long, k string, w string"), mode="sync_all")
    assert table.read().columns == ["id", "k", "w"] and rows(table.read().filter("id in (1, 2)")) == [(1, "a", "new"), (2, "a", "x")]
    # a column of the same name has no old values
    table.upsert(make(spark, [(2, "a", "x", 9)], "id long, k string, w string, v int"))
    assert rows(table.read().filter("id in (1, 2)")) == [(1, "a", "new", None), (2, "a", "x", 9)] and table.read().count() == 201


def test_repeated_keys_nulls_deletes_and_empty_batches(spark, table):
    table.upsert(make(spark, [(1, "a", 5), (1, "a", 6), (None, "n", 2)]), order=[F.col("v").desc()])
    assert rows(table.read().filter("id = 1 or id is null")) == [(1, "a", 6), (None, "n", 1), (None, "n", 2)]
    assert table.upsert(make(spark, [])) == 2 and table.read().count() == 202
    table.delete(make(spark, [(1, "a", 0), (77, "zz", 0)]))
    assert table.read().filter("id = 1").count() == 0 and table.read().count() == 201
    fresh = BucketedTable(spark, run_dir(spark, "none"), ["id"])
    assert fresh.latest() is None
    fresh.upsert(make(spark, []))
    assert fresh.read().count() == 0 and fresh.read().columns == ["id", "k", "v"]


def test_vacuum_keeps_what_is_read(spark, table):
    for n in range(4):
        table.upsert(make(spark, [(n, "a", -1), (1000 + n, "a", n)]))
    want = rows(table.read())
    assert table.vacuum(keep=1) > 0 and table.versions() == [4]
    assert rows(table.read()) == want and rows(BucketedTable(spark, table.base, ["id", "k"]).read()) == want
    folders = {os.path.join(d, p) for d in os.listdir(os.path.join(table.base, "data")) for p in os.listdir(os.path.join(table.base, "data", d)) if p.startswith(BUCKET)}
    assert folders == {f.removeprefix("data/") for f in table.files_of().values()}
