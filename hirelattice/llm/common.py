"""Shared steps: tables between stages, and connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelattice.session import prepare, run_dir

# rows of long texts that pass between Spark and Python at once
BATCH_ROWS = 1024


def ready(spark: SparkSession) -> SparkSession:
    """The session with its time zone pinned and batches small enough for whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
    return prepare(spark)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the folder that all executors share and go on from the file.

    Cuts lineage, survives lost executors, fixes rows that are read twice, and gives Spark the true
    size, so that it broadcasts only what is small and splits skewed joins (both sides are then scans).
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a ``stored`` table that later steps don't read again."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def total(df: DataFrame, *sums) -> tuple:
    """The one row of global aggregates, with 0 for null."""
    return tuple(v or 0 for v in df.agg(*sums).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; component is the least node reachable.

    Each round points every node at the neighbour of least hash and contracts the edges, so a star
    goes in one round and a chain halves at least; hashed order makes the rounds logarithmic whatever
    the ids. Null ends and loops are ignored. All steps are aggregates with map-side combine and joins
    of stored tables, which Spark splits where a node is hot.
    """
    ends = edges.select("a", "b").where("a <> b")
    rounds: list[DataFrame] = []
    while True:
        ends = stored(ends.distinct(), "edges")
        if ends.isEmpty():
            break
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(len(rounds))).alias("h"), c.alias("n"))
        both = ends.union(ends.select("b", "a"))
        least = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        up = stored(least.select(F.col("a").alias("node"), F.least(rank(F.col("a")), "m")["n"].alias("up")), "up")
        rounds.append(up)
        left, right = up.toDF("a", "pa"), up.toDF("b", "pb")
        ends = ends.join(left, "a").join(right, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")).where("a <> b")
    if not rounds:
        kind = edges.schema["a"].dataType
        return ends.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("component"))
    full = rounds[0]
    for after in rounds[1:]:
        step = after.toDF("up", "next")
        full = full.join(step, "up", "left").select("node", F.coalesce("next", "up").alias("up"))
    full = stored(full, "roots")
    names = stored(full.groupBy("up").agg(F.min("node").alias("component")), "names")
    return full.join(names, "up").select("node", "component")
