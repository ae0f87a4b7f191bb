"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app: str = "hirelattice", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; the cluster's own settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone, which every timestamp cast below depends on."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it then gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="hirelattice-")
        spark.sparkContext.setCheckpointDir(base)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is ever written twice to one path."""
    return os.path.join(shared_dir(spark), "runs", f"{name}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the stored rows.

    Used where later steps must see exactly the same rows again, also after an executor is lost.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(scan: DataFrame) -> DataFrame:
    """Spread the rows of a scan that has fewer splits than the session has cores.

    For work that costs much per row, such as long texts in a file that cannot be split. ``scan`` must
    be a plain read; a scan with enough splits is left as it is, so a large table is never shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Ask for a broadcast only after counting that ``df`` is small; else let Spark choose the join.

    For the results of aggregates, whose size Spark cannot tell before it has shuffled the other side.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def join_hot(large: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi join on ``key`` where a few values may hold most rows of ``large`` (``how`` is inner, left or left_anti).

    A digest as a further key makes Spark deal out both sides anew, also one that an aggregate has left partitioned by the
    key; only then can AQE split the rows of a hot value over several tasks and hand each the other side's few rows.
    """
    digest = F.xxhash64(key).alias("_digest")
    return large.select("*", digest).join(small.select("*", digest), [key, "_digest"], how).drop("_digest")
