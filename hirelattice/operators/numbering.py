"""Consecutive row numbers without pulling all rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hirelattice.session import cut


def number_rows(df: DataFrame, order: list, name: str = "row_id") -> DataFrame:
    """Number all rows 1..n by ``order``, which should end in a unique column.

    A range shuffle sorts the rows, so a value held by very many rows is still split by the later
    sort columns. The sorted rows are stored once, because the offsets and the rows must agree;
    each partition then adds the row counts of the partitions before it. The only window runs over
    one row per partition.
    """
    ranged = df.repartitionByRange(*[_column(c) for c in order]).sortWithinPartitions(*[_column(c) for c in order])
    stored = cut(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part, pos = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    stored = stored.withColumn("_part", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part").agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    # at most one row per partition of the range shuffle
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_before") + pos + 1).cast("bigint"))
        .drop("_part", "_at", "_before")
    )


def _column(c):
    return F.col(c) if isinstance(c, str) else c
