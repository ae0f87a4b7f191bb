"""The calendar dimension and its date parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# French month and weekday names (weekday 1 is Sunday).
MONTHS = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre",
          "novembre", "décembre"]
WEEKDAYS = ["dimanche", "lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi"]


def month_name(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTHS)), F.month(day))


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.dayofweek(day))


def date_parts(df: DataFrame, day_column: str) -> DataFrame:
    """Semester, month, day, names and weekend flag of a date column; no locale is involved."""
    d = F.col(day_column)
    return df.withColumns({
        "semestre": F.ceil(F.month(d) / 6).cast("bigint"), "mois": F.month(d).cast("bigint"),
        "jour": F.dayofmonth(d).cast("bigint"), "mois_nom": month_name(d), "jour_semaine": weekday_name(d),
        "week_end": F.dayofweek(d).isin(1, 7)})


def calendar(spark: SparkSession, lo: str, hi: str) -> DataFrame:
    """One row per day of the closed range, keyed by ``id_date``."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"))).alias("id_date"))
    return date_parts(days, "id_date")
