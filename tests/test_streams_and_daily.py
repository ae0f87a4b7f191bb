import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from hirelattice.functions.calendar import calendar
from hirelattice.operators.bucketed import BucketedTable
from hirelattice.operators.dedup import clean_offers
from hirelattice.operators.search import day_slice
from hirelattice.plans import daily
from hirelattice.plans.bindings import CONTRACTS, REMOTE_MODES, SENIORITIES
from hirelattice.session import run_dir
from hirelattice.streaming import jobs

SCHEMA = "id long, k string, ts timestamp, v int"


def _land(spark, path, batches):
    for batch in batches:
        df = spark.createDataFrame([(i, k, ts, v) for i, k, ts, v in batch], "id long, k string, ts string, v int")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    return jobs.read_files(spark, path, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def _files(spark, batches):
    path = run_dir(spark, "in")
    _land(spark, path, batches)
    return _stream(spark, path)


D = "2024-01-01 "
BATCHES = [[(1, "a", D + "10:00:00", 1), (2, "b", D + "10:01:00", 1)],
           [(3, "a", D + "10:30:00", 2), (4, "a", D + "10:31:00", 3)],
           [(5, "c", D + "10:02:00", 1), (6, "b", D + "11:00:00", 2)],
           [(7, "z", D + "12:00:00", 0)]]


def test_first_row_wins_over_batches(spark):
    def first(batches, within):
        target = run_dir(spark, "first")
        with jobs.stateful(spark):
            progress = jobs.to_files(jobs.first_wins(_files(spark, batches), ["k"], ["id"], "ts", within), target)
        return rows(spark.read.parquet(f"{target}/data").select("k", "id")), [p["stateOperators"][0]["numRowsTotal"] for p in progress]

    got, _ = first(BATCHES, "1 day")
    assert got == [("a", 1), ("b", 2), ("c", 5), ("z", 7)]
    # rows of one batch come in any order; a row without a time counts too
    got, _ = first([[(9, "a", D + "10:00:00", 1), (3, "a", D + "10:05:00", 1), (4, "n", None, 1)], [(1, "a", D + "10:01:00", 1)]], "1 day")
    assert got == [("a", 3), ("n", 4)]
    # many keys, then nothing but new ones much later: the old keys are forgotten, late rows of theirs dropped
    many = [[(i, f"k{i}", D + "10:00:00", 1) for i in range(200)], [(500, "z", D + "20:00:00", 1)], [(501, "z", D + "20:01:00", 1), (502, "k1", D + "10:01:00", 1)]]
    got, state = first(many, "1 hour")
    assert len(got) == 201 and ("z", 500) in got and ("k1", 502) not in got
    assert max(state) >= 200 and state[-1] < 20


def test_upsert_over_batches(spark):
    target = run_dir(spark, "upsert")
    start = spark.createDataFrame([(0, "q", None, 9)], SCHEMA)
    out = jobs.upsert_stream(_files(spark, BATCHES), ["k"], [F.col("id").desc()], target, start)
    want = [("a", 4), ("b", 6), ("c", 5), ("q", 0), ("z", 7)]
    assert rows(out.select("k", "id")) == want
    # versions no longer read are gone; a second stream goes on from the table, its batches being numbered anew
    table = BucketedTable(spark, f"{target}/table", ["k"])
    assert len(table.versions()) == 2
    more = run_dir(spark, "more")
    more_rows = _files(spark, [[(9, "q", D + "13:00:00", 1)], [(10, "a", D + "13:01:00", 1)]])
    jobs._into(table, more_rows, [F.col("id").desc()], more, "append")
    assert rows(table.read().select("k", "id")) == [("a", 10), ("b", 6), ("c", 5), ("q", 9), ("z", 7)]


def test_a_batch_of_an_upsert_that_is_run_again_changes_nothing(spark, monkeypatch):
    target, seen = run_dir(spark, "again"), []
    whole = BucketedTable.upsert

    def twice(self, batch, **options):
        seen.append(options["writer"])
        first = whole(self, batch, **options)
        assert whole(self, batch, **options) == first
        if len(seen) == 2:
            raise OSError("lost after the switch")
        return first

    monkeypatch.setattr(BucketedTable, "upsert", twice)
    source = run_dir(spark, "in")
    _land(spark, source, BATCHES)
    start = lambda: jobs.upsert_stream(_stream(spark, source), ["k"], [F.col("id").desc()], target)
    with pytest.raises(Exception, match="lost"):
        start()
    assert rows(start().select("k", "id")) == [("a", 4), ("b", 6), ("c", 5), ("z", 7)]
    # the second batch came again under its own number
    assert [n for _, n in seen] == [0, 1, 1, 2, 3] and len({s for s, _ in seen}) == 1


def test_open_windows_are_stored_and_replaced(spark):
    source, target = run_dir(spark, "in"), run_dir(spark, "open")
    count = lambda: jobs.to_table(jobs.count_by_label(_stream(spark, source), "ts", "k").select("window.start", "k", "n"), ["start", "k"], target)
    shown = lambda df: rows(df.select("k", F.date_format("start", "HH:mm"), "n"))
    _land(spark, source, [[(1, "a", D + "10:00:00", 1), (2, "a", D + "10:01:00", 1)]])
    assert shown(count()) == [("a", "10:00", 2)]
    # a row of the open window comes later, then one beyond the watermark's delay that is dropped
    _land(spark, source, [[(3, "a", D + "10:02:00", 1), (4, "b", D + "10:30:00", 1)], [(5, "z", D + "10:31:00", 1)], [(6, "a", D + "10:03:00", 1)]])
    assert shown(count()) == [("a", "10:00", 3), ("b", "10:30", 1), ("z", "10:30", 1)]


def test_late_rows_are_dropped_and_open_windows_wait(spark):
    out = run_dir(spark, "count")
    late = BATCHES[:3] + [[*BATCHES[3], (8, "d", D + "10:03:00", 1)]]
    jobs.to_files(jobs.count_by_label(_files(spark, late), "ts", "k"), out)
    got = rows(spark.read.parquet(f"{out}/data").select("k", F.date_format("window.start", "HH:mm"), "n"))
    # d at 10:03 comes when the watermark has passed 10:20, c came before that; z's window is still open
    assert got == [("a", "10:00", 1), ("a", "10:30", 2), ("b", "10:00", 1), ("b", "11:00", 1), ("c", "10:00", 1)]


def _sustained(spark, source, target, minutes):
    with jobs.stateful(spark):
        told = jobs.sustained_stream(_stream(spark, source), "k", "ts", F.col("v") > 0, minutes)
        return jobs.to_table(told, ["k", "started"], target).filter("fired is not null")


def _plain(spark, data, minutes):
    batch = spark.createDataFrame(data, "id long, k string, ts string, v int").withColumn("ts", F.col("ts").cast("timestamp"))
    return rows(jobs.sustained(jobs.condition_steps(batch, "k", "ts", F.col("v") > 0), "k", minutes).select("k", "started", "fired"))


def test_sustained_stream_equals_batch(spark):
    rows_in = [(i, "x" if i % 2 else "y", D + f"{9 + i // 60:02d}:{i % 60:02d}:30", (i // 7) % 3) for i in range(120)]
    source, target, seen = run_dir(spark, "in"), run_dir(spark, "out"), []
    # two runs on the same checkpoints: a run of the condition goes on where the first one stopped, and open steps count
    for batches in ([rows_in[:40], rows_in[40:64]], [rows_in[64:90], rows_in[90:]]):
        _land(spark, source, batches)
        seen += [r for batch in batches for r in batch]
        got = _sustained(spark, source, target, 5)
        assert rows(got.select("k", "started", "fired")) == _plain(spark, seen, 5) != []


def test_a_run_told_too_early_is_taken_back(spark):
    source, target = run_dir(spark, "in"), run_dir(spark, "out")
    first = [(i, "a", D + f"10:0{i}:10", 1) for i in range(4)]
    _land(spark, source, [first])
    assert rows(_sustained(spark, source, target, 3).select("k", F.date_format("fired", "HH:mm"))) == [("a", "10:03")]
    # a later row of an open step before the end turns it off, rows in no order, one key without a run, a row without a time
    more = [(9, "a", D + "10:02:50", 0), (8, "a", D + "10:05:10", 1), (7, "a", D + "10:04:10", 1), (10, "b", D + "10:04:10", 0), (11, "b", None, 1), (12, "b", D + "10:04:20", None)]
    _land(spark, source, [more])
    assert rows(_sustained(spark, source, target, 3)) == [] == _plain(spark, first + more, 3)
    last = [(20, "a", D + "10:06:10", 1)]
    _land(spark, source, [last])
    got = _sustained(spark, source, target, 3)
    assert rows(got.select("k", "started", "fired")) == _plain(spark, first + more + last, 3) != []


def test_a_backlog_of_one_key_goes_through_and_its_state_shrinks(spark):
    source, target, n = run_dir(spark, "in"), run_dir(spark, "out"), 1_000_000
    steps = spark.range(n).select("id", F.lit("a").alias("k"), F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 60).alias("ts"), (F.col("id") % 1000 > 0).cast("int").alias("v"))
    steps.coalesce(1).write.parquet(source)
    out = _sustained(spark, source, target, 900)
    assert out.count() == n // 1000 and out.filter("unix_timestamp(fired) - unix_timestamp(started) <> 900 * 60").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=40), st.integers(0, 40), st.integers(1, 6))
def test_runs_of_pieces_are_runs_of_the_whole(flags, cut, need):
    steps, on = np.arange(len(flags)) * 2, np.array(flags, bool)
    want, started, fired = {}, None, None
    for s, f in zip(steps.tolist(), flags):
        if not f:
            started = fired = None
            continue
        started = s if started is None else started
        if fired is None and s >= started + need:
            fired = want[started] = s
    whole = jobs.runs_of(steps, on, None, None, need)
    assert {s: f for s, f in zip(*map(np.ndarray.tolist, whole[:2])) if f >= 0} == want and whole[2] == (started, fired)
    a = jobs.runs_of(steps[:cut], on[:cut], None, None, need)
    b = jobs.runs_of(steps[cut:], on[cut:], *a[2], need)
    assert {s: f for part in (a, b) for s, f in zip(*map(np.ndarray.tolist, part[:2])) if f >= 0} == want and b[2] == (started, fired)


def _raw(spark, data):
    names = ["id_offre", "id_local", "description", "sector", "skills", "contract_type", "contract_duration", "experience_required",
             "location_name", "latitude", "longitude", "company_name", "code_rome", "date_created", "date_updated", "date_extraction"]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in data],
                               ", ".join(f"{n} {'long' if n == 'id_offre' else 'string'}" for n in names))
    return df.withColumns({n: F.col(n).cast("timestamp") for n in names if n.startswith("date_")})


def test_daily_run(spark):
    day = "2024-03-01 08:00:00"
    dims = daily.Dimensions(
        CONTRACTS, SENIORITIES, REMOTE_MODES,
        spark.createDataFrame([(1, 75001, "Paris", "Seine", "IDF", "France", 48.86, 2.35, 9)],
                              "id_lieu long, code_postal long, ville string, departement string, region string, pays string, latitude double, longitude double, population long"),
        spark.createDataFrame([(11, "Acme", "GE")], "siren long, nom_entreprise string, categorie_entreprise string"),
        calendar(spark, "2024-01-01", "2024-12-31"),
        spark.createDataFrame([(5, "m1805")], "id_rome long, code_rome string"),
        spark.createDataFrame([(3, "banque")], "id_domaine int, nom_domaine string"),
        spark.createDataFrame([("les",)], "word string"),
        spark.createDataFrame([(21, "sql"), (22, "java")], "id_competence long, skill string"))
    first = {"id_offre": 1, "id_local": "A", "description": "un cdi junior avec sql et télétravail", "sector": "banque", "contract_type": "x",
             "location_name": "Paris", "company_name": "ACME sa", "code_rome": "M1805", "date_created": "2024-02-01 00:00:00", "date_extraction": day}
    again = {**first, "id_offre": 2, "date_extraction": "2024-03-02 08:00:00"}
    other = {"id_offre": 3, "id_local": "B", "date_extraction": "2024-03-02 08:00:00", "skills": "un java ici"}
    target = run_dir(spark, "daily")
    fact, bridge = daily.run(_raw(spark, [first]), dims, "2024-03-01", target, 64)
    row = fact.first().asDict()
    assert {k: str(v) for k, v in row.items()} == {
        "id_offre": "1", "id_local": "A", "id_contrat": "1", "id_seniorite": "1", "id_teletravail": "1", "id_lieu": "1", "id_entreprise": "11",
        "id_domaine": "3", "id_rome": "5", "id_date_creation": "2024-02-01", "id_date_modification": "1900-01-01"}
    assert rows(bridge) == [(1, 21)]
    # the next day: the repeated offer keeps its first extraction, so only the new one is of the day
    table = BucketedTable(spark, f"{target}/fact", ["id_local"])
    before = table.files_of()
    for _ in range(2):  # the second run of the day changes nothing
        fact, bridge = daily.run(_raw(spark, [first, again, other]), dims, "2024-03-02", target, 64)
        assert rows(fact.select("id_local", "id_contrat")) == [("A", 1), ("B", None)]
        assert rows(bridge) == [(1, 21), (3, 22)]
    assert len(before) == 1 and all(table.files_of()[k] == v for k, v in before.items()) and len(table.files_of()) == 2


def test_offers_of_a_day_are_those_of_the_ranking_of_all(spark):
    draw = random.Random(5)
    data = [{"id_offre": i, "id_local": draw.choice("ABCDEFGH") if i % 9 else None,
             "date_extraction": f"2024-03-{draw.randint(1, 4):02d} 0{draw.randint(0, 3)}:00:00" if i % 7 else None} for i in range(60)]
    raw = _raw(spark, data)
    for day in ("2024-03-01", "2024-03-02", "2024-03-03", "2024-03-05"):
        want = day_slice(clean_offers(raw, keep_rank=False), "date_extraction", day)
        assert rows(daily.todays_offers(raw, day)) == rows(want)


def test_first_rows_keep_one_state_for_a_bucket_of_keys(spark):
    # keys of two columns, null ones too, in three batches; one state each for 3000 keys before
    batches = [[(i + 10_000 * n, None if i % 50 == 0 else f"k{i % 3000}", f"{D}1{n}:{i % 60:02}:00", None if i % 7 == 0 else i % 2) for i in range(n * 1000, 3000 + n)] for n in range(3)]
    target = run_dir(spark, "first")
    with jobs.stateful(spark):
        stream = jobs.first_wins(_files(spark, batches), ["k", "v"], ["id"], "ts", "1 day", buckets=20)
        progress = jobs.to_files(stream, target)
    want = {}
    for batch in batches:
        for i, k, _, v in batch:
            want.setdefault((k, v), i)
    assert rows(spark.read.parquet(f"{target}/data").select("k", "v", "id")) == sorted(((k, v, i) for (k, v), i in want.items()), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in progress) <= 20
