"""Streaming ingestion, de-duplication, enrichment, upserts and monitoring.

All sinks are file sinks or keyed by the batch number, so a batch that is run again after a failure
gives the same rows once. Checkpoints and results live under the shared folder.
"""

from __future__ import annotations

import contextlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from hirelattice.operators.bucketed import BucketedTable
from hirelattice.operators.dedup import dedup_rank
from hirelattice.sources.readers import parse_csv

DELAY = "10 minutes"
# of the keys a stream remembers
BUCKETS = 1 << 13


def read_files(
    spark: SparkSession, folder: str, schema: T.StructType, name_glob: str = "*.parquet", files_per_batch: int | None = None,
    dialect: str | None = None,
) -> DataFrame:
    """New files of a folder as a stream, each exactly once; the schema is given, never inferred.

    Files are Parquet, or with a ``dialect`` delimited text, plain or compressed, as ``readers.parse_csv`` reads it.
    """
    reader = spark.readStream.option("pathGlobFilter", name_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_csv(reader, folder, schema, dialect) if dialect else reader.schema(schema).parquet(folder)


def drain(writer: DataStreamWriter) -> list[dict]:
    """Process everything that is there, in as many batches as needed, and stop; the progress of the last batches."""
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    return running.recentProgress


def to_files(stream: DataFrame, target: str) -> list[dict]:
    """Append to a folder; its own log of finished files makes every row appear once."""
    return drain(stream.writeStream.format("parquet").outputMode("append").option("path", f"{target}/data").option("checkpointLocation", f"{target}/log"))


def ingest(spark: SparkSession, folder: str, schema: T.StructType, target: str, **options) -> DataFrame:
    to_files(read_files(spark, folder, schema, **options), target)
    return spark.read.parquet(f"{target}/data")


def dedup_stream(stream: DataFrame, keys: list[str], ts: str, delay: str = DELAY) -> DataFrame:
    """One row per key; a repeat is recognised as long as it is no later than the delay. Which of two
    rows of one batch stays is not defined; ``first_wins`` defines it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


class _FirstRows(StatefulProcessor):
    """Lets the first row of every key of a bucket through and remembers each key until the watermark has passed its last row.

    A bucket's keys and their last times are one value; the earliest of these times is its one timer.
    """

    def __init__(self, order: list[str], ts: str):
        self.order, self.ts = order, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("last", T.BinaryType())]))

    def _load(self) -> dict[str, int]:
        return pickle.loads(bytes(self.last.get()[0])) if self.last.exists() else {}

    def _save(self, last: dict[str, int], timer: int | None) -> None:
        ends = min(last.values()) if last else None
        if ends != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if ends is not None:
                self.handle.registerTimer(ends)
        if last:
            self.last.update((pickle.dumps(last),))
        else:
            self.last.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self._load()
        timer = min(last.values()) if last else None
        first, newest = None, {}
        for part in rows:  # a piece of the bucket at a time
            names, times = part["k"].tolist(), pd.to_datetime(part[self.ts])
            for k, at, there in zip(names, (times.astype("datetime64[ns]").astype("int64") // 1_000_000).tolist(), times.notna().tolist()):
                if not there:
                    newest.setdefault(k, None)
                elif newest.get(k) is None or at > newest[k]:
                    newest[k] = at
            new = [k not in last for k in names]
            if any(new):
                some = part[new] if first is None else pd.concat([first, part[new]])
                first = some.sort_values(self.order, kind="stable").drop_duplicates("k")
        changed = False
        for k, at in newest.items():
            if at is None and k not in last:  # rows without a time: remembered until the watermark moves on
                at = timerValues.getCurrentWatermarkInMs()
            if at is not None and (k not in last or at > last[k]):
                last[k], changed = at, True
        if changed:
            self._save(last, timer)
        if first is not None:
            yield first.drop(columns=["b", "k"]).reset_index(drop=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self._load()
        timer, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        self._save({k: at for k, at in last.items() if at > max(timer, watermark)}, None)
        return iter([])


def _key_text(kind: T.DataType, key: Column) -> Column:
    """A text that tells the values of a key apart; null stays null."""
    if isinstance(kind, T.BinaryType):
        return F.base64(key)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (key + F.lit(0.0)).cast("string")  # one zero
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(key, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"})
    return key.cast("string")


def first_wins(stream: DataFrame, keys: list[str], order: list[str], ts: str, within: str = DELAY, buckets: int = BUCKETS) -> DataFrame:
    """The first row of every key, by the columns ``order`` among rows that come together.

    A key is remembered until event time is ``within`` past its last row, and rows that come later than that
    are dropped, so the state is that of the keys of the last ``within``. Keys lie in ``buckets`` by a hash; a batch opens, once each, the
    buckets its rows lie in, so what is done per key is a look into a dictionary. ``buckets`` stays as it is for the life of a stream.
    The state store is RocksDB, which the session must name where the stream is started (``stateful``).
    """
    # plain names inside: rows reach the processor as named tuples, which change others
    plain = {c: f"c{i}" for i, c in enumerate(stream.columns)}
    rows = stream.toDF(*plain.values()).withWatermark(plain[ts], within)
    kinds = {c: stream.schema[c].dataType for c in keys}
    name = F.to_json(F.array(*[_key_text(kinds[c], F.col(plain[c])) for c in keys]))
    work = _FirstRows([plain[c] for c in order], plain[ts])
    dealt = rows.withColumn("k", name).withColumn("b", F.pmod(F.hash("k"), F.lit(buckets)))
    return dealt.groupBy("b").transformWithStateInPandas(work, rows.schema, "Append", "EventTime").toDF(*stream.columns)


@contextlib.contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, as timers ask for."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def enrich(stream: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """Left-join static dimensions to a stream of offers."""
    for dim, key in dims:
        stream = stream.join(dim, key, "left")
    return stream


def upsert_stream(
    stream: DataFrame, keys: list[str], order: list, target: str, initial: DataFrame | None = None, buckets: int = 8,
) -> DataFrame:
    """Upsert every batch into a stored table and return the table as it is afterwards.

    A batch writes the buckets that its keys lie in. The table knows the last batch it holds of each stream, so one
    that is run again after a failure changes nothing. Of rows of one key the first in ``order`` counts.
    """
    table = BucketedTable(stream.sparkSession, f"{target}/table", keys, buckets)
    if table.latest() is None:
        # the first run lays the base; a later run on the same target goes on from what is there
        table.replace(initial if initial is not None else stream.sparkSession.createDataFrame([], stream.schema))
    _into(table, stream, order, f"{target}/log", "append")
    return table.read()


def to_table(stream: DataFrame, keys: list[str], target: str, buckets: int = 8) -> DataFrame:
    """Store what a stream of aggregates knows of every key, that of open windows included.

    Each batch replaces the rows of the keys it has changed, so a window is there from its first event on and
    final once the watermark has passed it. A batch that is run again changes nothing.
    """
    table = BucketedTable(stream.sparkSession, f"{target}/table", keys, buckets)
    if table.latest() is None:
        table.replace(stream.sparkSession.createDataFrame([], stream.schema))
    _into(table, stream, None, f"{target}/log", "update")
    return table.read()


def _into(table: BucketedTable, stream: DataFrame, order: list | None, log: str, mode: str) -> None:
    def step(batch: DataFrame, number: int) -> None:
        # batches are numbered for each checkpoint, which the id of the stream stands for
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.upsert(batch, order=order, writer=(stream_id, number))
        table.vacuum()

    drain(stream.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", log))


def windowed(stream: DataFrame, ts: str, labels: list[str | Column], length: str, slide: str | None = None, delay: str = DELAY):
    """Group a stream or a table by time window and labels; on a stream late rows are waited for."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    rows = stream.withWatermark(ts, delay) if stream.isStreaming else stream
    return rows.groupBy(window.alias("window"), *labels)


def count_by_label(stream: DataFrame, ts: str, label: str, length: str = "5 minutes", **options) -> DataFrame:
    return windowed(stream, ts, [label], length, **options).agg(F.count("*").alias("n"))


def status_class(label: Column, errors: list[str], client: list[str]) -> Column:
    """Requests as 2xx, 4xx or 5xx by their label."""
    return F.when(label.isin(errors), "5xx").when(label.isin(client), "4xx").otherwise("2xx")


def rate_by_class(stream: DataFrame, ts: str, status: Column, seconds: int = 300, slide: str = "1 minute", **options) -> DataFrame:
    """Requests per second and class in a sliding window. Events are rows, so there are no counter resets."""
    out = windowed(stream, ts, [status.alias("status")], f"{seconds} seconds", slide, **options).agg(F.count("*").alias("n"))
    return out.withColumn("rate", F.col("n") / seconds)


def average_by_window(stream: DataFrame, ts: str, value: str, length: str = "5 minutes", **options) -> DataFrame:
    return windowed(stream, ts, [], length, **options).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), (F.sum(value) / F.count("*")).alias("average"))


def condition_steps(df: DataFrame, key: str, ts: str, condition: Column, step: str = "1 minute", delay: str = DELAY) -> DataFrame:
    """(key, at, is_on): the state of the condition at the last row of each step.

    Rows are reduced to one per key and step on the map side, so what follows handles a number of rows
    set by time and not by traffic.
    """
    rows = df.withColumn("_on", condition)
    return windowed(rows, ts, [key], step, delay=delay).agg(F.max_by("_on", ts).alias("is_on")).select(key, F.col("window.start").alias("at"), "is_on")


def sustained(steps: DataFrame, key: str, minutes: int) -> DataFrame:
    """(key, started, fired): runs of steps with the condition on that last ``minutes`` or more.

    A run starts at its first step after a step that was off; steps without rows change nothing.
    """
    by_key = Window.partitionBy(key).orderBy("at")
    off = F.sum(F.when(F.col("is_on"), 0).otherwise(1)).over(by_key)
    runs = steps.withColumn("_run", off).filter("is_on")
    runs = runs.withColumn("started", F.min("at").over(Window.partitionBy(key, "_run")))
    long = F.col("at") >= F.col("started") + F.expr(f"interval {minutes} minutes")
    return runs.filter(long).groupBy(key, "started").agg(F.min("at").alias("fired"))


def runs_of(steps: np.ndarray, on: np.ndarray, started: int | None, fired: int | None, need: int):
    """The runs of ascending steps, as (started, fired or -1) arrays, and the run open at the end as (started, fired).

    ``started`` and ``fired`` are those of the run open before the first step.
    """
    if not len(steps):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), (started, fired)
    run = np.cumsum(~on)
    kept, lit = run[on], steps[on]
    number, first = np.unique(kept, return_index=True)
    begun, done = lit[first].copy(), np.full(len(number), -1, np.int64)
    if len(number) and number[0] == 0 and started is not None:
        begun[0], done[0] = started, -1 if fired is None else fired
    long = lit >= np.repeat(begun, np.diff(np.append(first, len(lit)))) + need
    at, where = np.unique(kept[long], return_index=True)
    place = np.searchsorted(number, at)
    done[place] = np.where(done[place] < 0, lit[long][where], done[place])
    if on[-1]:
        return begun, done, (int(begun[-1]), None if done[-1] < 0 else int(done[-1]))
    return begun, done, (None, None)


_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("started", "fired", "timer")] + [
    T.StructField(c, T.BinaryType()) for c in ("steps", "last", "on", "told", "told_fired")])


class _Sustained(StatefulProcessor):
    """Per key: the run up to the last closed step, and the steps that the watermark has not closed, as arrays.

    What an open step makes true is told at once and taken back, by a row without ``fired``, if a later row changes it.
    """

    def __init__(self, step: int, need: int):
        self.step, self.need = step, need

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("run", _RUN)

    def _load(self):
        if not self.state.exists():
            return None, None, None, [np.zeros(0, k) for k in (np.int64, np.int64, np.bool_, np.int64, np.int64)]
        started, fired, timer, *arrays = self.state.get()
        kinds = (np.int64, np.int64, np.bool_, np.int64, np.int64)
        return started, fired, timer, [np.frombuffer(bytes(a), k) for a, k in zip(arrays, kinds)]

    def _close(self, started, fired, steps, last, on, watermark: int):
        """Fold the steps that end at the watermark (microseconds) or before into the run."""
        closed = steps + self.step <= watermark
        _, _, (started, fired) = runs_of(steps[closed], on[closed], started, fired, self.need)
        return started, fired, steps[~closed], last[~closed], on[~closed]

    def _save(self, started, fired, timer, *arrays) -> None:
        ends = int(arrays[0][-1] + self.step) // 1000 if len(arrays[0]) else None
        if ends != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if ends is not None:
                self.handle.registerTimer(ends)
        self.state.update((started, fired, ends, *(a.tobytes() for a in arrays)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        started, fired, timer, (steps, last, on, told, told_fired) = self._load()
        for part in rows:  # a piece of the batch at a time, reduced to its steps
            part = part[part["at"].notna()]
            at = part["at"].to_numpy("datetime64[us]").astype(np.int64)
            state = (part["state"] == True).to_numpy(bool)  # noqa: E712  null is off
            steps, last, on = np.concatenate([steps, at - at % self.step]), np.concatenate([last, at]), np.concatenate([on, state])
            order = np.lexsort((last, steps))
            final = order[np.append(np.diff(steps[order]) != 0, True)] if len(order) else order
            steps, last, on = steps[final], last[final], on[final]
        begun, done, _ = runs_of(steps, on, started, fired, self.need)
        now = dict(zip(begun[done >= 0].tolist(), done[done >= 0].tolist()))
        before = dict(zip(told.tolist(), told_fired.tolist()))
        changed = [(s, f) for s, f in now.items() if before.get(s) != f and not (s == started and f == fired)]
        changed += [(s, None) for s in before if s not in now and s != started]
        # what closed steps made true stays as it is
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        started, fired, steps, last, on = self._close(started, fired, steps, last, on, watermark)
        open_ = [s for s, f in now.items() if len(steps) and f >= steps[0]]
        self._save(started, fired, timer, steps, last, on, np.array(open_, np.int64), np.array([now[s] for s in open_], np.int64))
        if changed:
            yield pd.DataFrame({"key": [key[0]] * len(changed), "started": [pd.Timestamp(s * 1000) for s, _ in changed],
                                "fired": [pd.NaT if f is None else pd.Timestamp(f * 1000) for _, f in changed]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        started, fired, _, (steps, last, on, *_) = self._load()
        closed = self._close(started, fired, steps, last, on, timerValues.getCurrentWatermarkInMs() * 1000)
        none = np.zeros(0, np.int64)
        self._save(closed[0], closed[1], None, *closed[2:], none, none)
        return iter([])


def sustained_stream(stream: DataFrame, key: str, ts: str, condition: Column, minutes: int, step_seconds: int = 60, delay: str = DELAY) -> DataFrame:
    """``sustained`` over ``condition_steps`` of a stream of rows: (key, started, fired), in update mode.

    A run is told as soon as a step, open or closed, makes it long enough; rows of one ``key`` and ``started`` replace each
    other, and one without ``fired`` takes a run back that a later row of an open step has ended. A key keeps the
    run it is in and the steps that the watermark has not closed, 17 bytes each, whatever its traffic; a timer folds the
    steps into the run once they are closed. Rows later than ``delay`` are dropped. The session needs ``stateful``.
    """
    rows = stream.select(F.col(key).alias("key"), F.col(ts).alias("at"), condition.alias("state")).withWatermark("at", delay)
    out = T.StructType([T.StructField("key", stream.schema[key].dataType), T.StructField("started", T.TimestampType()), T.StructField("fired", T.TimestampType())])
    work = _Sustained(step_seconds * 1_000_000, minutes * 60_000_000)
    return rows.groupBy("key").transformWithStateInPandas(work, out, "Update", "EventTime").withColumnRenamed("key", key)
