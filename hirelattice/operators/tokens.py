"""Tokenising and stop words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The characters that separate tokens besides the blank.
SEPARATORS = "[-',.,\"]+"

# Words dropped on top of the general stop-word list.
CUSTOM_STOPWORDS = [
    "faire", "sens", "information", "situation", "environnement", "france", "preuve", "dater", "etude", "ingenieure",
    "capacite", "interlocuteur", "vue", "heure", "action", "technicienn",
]


def read_stopwords(spark: SparkSession, path: str, column: str = "word") -> DataFrame:
    """A stop-word list is data: one word per row of a headed CSV file."""
    return spark.read.option("header", "true").csv(path).select(F.col(column).alias("word"))


def with_custom(stopwords: DataFrame) -> DataFrame:
    extra = stopwords.sparkSession.createDataFrame([(w,) for w in CUSTOM_STOPWORDS], "word string")
    return stopwords.select("word").unionByName(extra).distinct()


def split_tokens(text: Column) -> Column:
    return F.split(F.regexp_replace(F.lower(text), SEPARATORS, " "), " ")


def exploded(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, token) for every piece of the text, empty pieces included."""
    return df.select(id_column, F.explode(split_tokens(F.col(text_column))).alias("token")).withColumn("token", F.trim("token"))


def tokens(df: DataFrame, id_column: str, text_column: str, stopwords: DataFrame, min_length: int = 3) -> DataFrame:
    """(id, token) without short tokens and stop words; the text itself is not carried along.

    Stop words never are null in the list, which ``not_in`` would turn into an empty result.
    """
    words = stopwords.select(F.col("word").alias("token")).filter("token is not null").distinct()
    return exploded(df, id_column, text_column).filter(F.length("token") >= min_length).join(words, "token", "left_anti").select(id_column, "token")


def token_counts(df: DataFrame, id_column: str, text_column: str, stopwords: DataFrame, min_length: int = 3) -> DataFrame:
    """(id, token, n): repeats are merged before anything is joined."""
    return tokens(df, id_column, text_column, stopwords, min_length).groupBy(id_column, "token").agg(F.count("*").alias("n"))


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """SQL ``NOT IN``: a null among the others gives no rows at all, a null on the left is dropped.

    Whether there is a null is one aggregate; the rest is a plain anti join.
    """
    others = other.select(F.col(other_column).alias("_other"))
    n_all = others.agg(F.count("*")).scalar()
    n_null = others.agg(F.count_if(F.col("_other").isNull())).scalar()
    kept = df.filter((n_all == 0) | ((n_null == 0) & F.col(column).isNotNull()))
    return kept.join(others, F.col(column) == F.col("_other"), "left_anti")
