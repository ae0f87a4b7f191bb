"""Role-playing date match."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hirelattice.operators.dedup import dedup_rank


def date_match(offers: DataFrame, calendar: DataFrame, default: str = "1900-01-01") -> DataFrame:
    """One row per local id: the calendar days of its newest creation and of the matching update.

    Days outside the calendar, and null dates, become the default day. The newest row is picked
    before the calendar is joined.
    """
    newest = dedup_rank(offers, ["id_local"], [F.col("date_created").desc_nulls_last(), F.col("id_offre").asc()])
    days = calendar.select(F.col("id_date").cast("date").alias("_day"))
    fallback = F.lit(default).cast("date")
    out = newest.select("id_offre", "id_local", F.to_date("date_created").alias("_c"), F.to_date("date_updated").alias("_u"))
    for src, name in (("_c", "id_date_created"), ("_u", "id_date_updated")):
        day = days.withColumnRenamed("_day", name)
        out = out.join(day, F.col(src) == F.col(name), "left").withColumn(name, F.coalesce(name, fallback))
    return out.drop("_c", "_u")
