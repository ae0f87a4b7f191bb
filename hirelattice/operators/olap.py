"""Counts, profiles and series over the fact and the wide table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed value: the label of the null bucket.
NO_LABEL = "Non étiqueté"


def top_places(fact: DataFrame, places: DataFrame, key: str, columns: list[str], n: int | None) -> DataFrame:
    """Offers per place, the most first, ties by the place columns; places without coordinates are left out.

    Offers are counted per place id before the join, so a place with a third of all offers is one row.
    ``columns`` decides what a place is: with coordinates, a city with two coordinates is two rows.
    """
    counts = fact.groupBy(key).agg(F.count("*").alias("_n"))
    located = places.filter("latitude is not null and longitude is not null")
    out = counts.join(located, key).groupBy(*columns).agg(F.sum("_n").alias("n_offers"))
    out = out.orderBy(F.col("n_offers").desc(), *[F.col(c).asc_nulls_last() for c in columns])
    return out.limit(n) if n else out


def value_counts(df: DataFrame, column: str, n: int | None = None, null_label: str | None = None) -> DataFrame:
    """(value, n) by falling count, ties by value; nulls get a bucket of their own or are dropped."""
    value = F.col(column).cast("string")
    rows = df.select(F.coalesce(value, F.lit(null_label)) if null_label else value).toDF("value")
    out = rows.filter("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    out = out.orderBy(F.col("n").desc(), F.col("value").asc())
    return out.limit(n) if n else out


def delimited_counts(df: DataFrame, column: str, sep: str = ",", n: int | None = None) -> DataFrame:
    """Count the trimmed pieces of a delimited column."""
    pieces = df.select(F.explode(F.split(F.col(column), sep)).alias("piece")).withColumn("piece", F.trim("piece"))
    return value_counts(pieces, "piece", n)


def missing_profile(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """(column, missing, percent) of every column, in one pass over the data, the most missing first."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in df.columns])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"m_{c}").alias("n_missing")) for c in df.columns]))
    out = counts.select("_n", pairs.alias("p")).select(
        "p.column_name", "p.n_missing", F.round(F.try_divide(F.col("p.n_missing") * F.lit(100.0), F.col("_n").cast("double")), 6).alias("pct"))
    if only_missing:
        out = out.filter("n_missing > 0")
    return out.orderBy(F.col("n_missing").desc(), F.col("column_name"))


def contingency(df: DataFrame, a: str, b: str, top: int | None = None) -> DataFrame:
    """(a, b, n) in long form: the number of columns does not grow with the data.

    ``top`` keeps rows whose two values are both among the most frequent ones.
    """
    rows = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    if top:
        for c in (a, b):
            best = value_counts(df, c, top).select(F.col("value").alias("_v"))
            rows = rows.join(best, F.col(c).cast("string") == F.col("_v"), "left_semi")
    return rows.groupBy(a, b).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, a: str, b: str, values: list) -> DataFrame:
    """The wide form for a known, small list of column values."""
    return df.groupBy(a).pivot(b, values).count().na.fill(0)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows, non-null rows, distinct values, longest text, least and greatest as text.

    The exact distinct counts are found one column at a time from grouped values, which are merged on
    the map side; a multi-column distinct aggregate would copy every row once per column.
    """
    base = df.agg(*[
        F.struct(
            F.count("*").alias("n_rows"), F.count(c).alias("n_known"),
            F.max(F.length(F.col(c).cast("string"))).cast("bigint").alias("max_length"),
            F.min(F.col(c)).cast("string").alias("least"), F.max(F.col(c)).cast("string").alias("greatest"),
        ).alias(c) for c in columns])
    stats = base.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("s")) for c in columns])).alias("x")).select("x.column_name", "x.s.*")
    distinct = reduce(DataFrame.unionByName, [
        df.select(c).filter(F.col(c).isNotNull()).distinct().agg(F.count("*").alias("n_distinct")).withColumn("column_name", F.lit(c))
        for c in columns])
    return stats.join(distinct, "column_name")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, mean, std, least, greatest) of number columns in one pass."""
    base = df.agg(*[
        F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(F.col(c).cast("double")).alias("least"), F.max(F.col(c).cast("double")).alias("greatest")).alias(c) for c in columns])
    return base.select(F.explode(F.array(*columns)).alias("x")).select("x.*")


def counters(df: DataFrame, label: str | Column, value: str) -> DataFrame:
    """Per label the number of requests, the sum and their ratio."""
    return df.groupBy(label).agg(F.count("*").alias("n"), F.sum(value).alias("total"),
                                 (F.sum(value) / F.count("*")).alias("average"))


def lag_feature(df: DataFrame, ts: str, value: str, keys: list[str]) -> DataFrame:
    """Add the value before, per series; the first row is filled with the next value known.

    Meant for series already summed per period, whose length is bounded by the calendar.
    """
    w = Window.partitionBy(*keys).orderBy(ts)
    ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = F.lag(value, 1).over(w)
    marked = df.withColumn("_lag", before)
    return marked.withColumn("lagged", F.coalesce("_lag", F.first("_lag", ignorenulls=True).over(ahead))).drop("_lag")
