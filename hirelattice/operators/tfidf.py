"""TF-IDF weights as a long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hirelattice.functions.text import words
from hirelattice.session import join_hot

# terms that are sent to all tasks at most
SENT = 50_000


def ngrams(pieces: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` words, joined by blanks; ``pieces`` should be a stored column."""

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(pieces) - n + 1)
        return F.when(F.size(pieces) >= n, F.transform(starts, lambda i: F.array_join(F.slice(pieces, i, n), " "))).otherwise(
            F.array().cast("array<string>"))

    return F.concat(*[pieces if n == 1 else runs(n) for n in range(low, high + 1)])


def term_counts(df: DataFrame, id_column: str, text_column: str, ngram: tuple[int, int] = (1, 1)) -> DataFrame:
    """(id, term, tf). The texts are dealt out by their id, which is all that is shuffled: their words are many times that."""
    pieces = df.select(id_column, text_column).repartition(id_column).select(id_column, words(F.col(text_column)).alias("_w"))
    return pieces.select(id_column, F.explode(ngrams(F.col("_w"), *ngram)).alias("term")).groupBy(id_column, "term").agg(
        F.count("*").alias("tf"))


def _bound(value: float | int, n: Column) -> Column:
    """A count as it is, a share as a share of all texts."""
    return F.lit(value) if isinstance(value, int) else F.lit(float(value)) * n


def vocabulary(
    counts: DataFrame, n_texts: Column, min_df: float | int = 1, max_df: float | int = 1.0, max_features: int | None = None
) -> DataFrame:
    """(term, df, idf) of the kept terms: within the bounds, the most used first, ties by term."""
    terms = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("_total"))
    terms = terms.withColumn("_n", n_texts).filter(
        (F.col("df") >= _bound(min_df, F.col("_n"))) & (F.col("df") <= _bound(max_df, F.col("_n"))))
    if max_features:
        terms = terms.orderBy(F.col("_total").desc(), F.col("term")).limit(max_features)
    idf = F.log((F.lit(1.0) + F.col("_n")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return terms.select("term", "df", idf.alias("idf"))


def tfidf(
    df: DataFrame, id_column: str, text_column: str, ngram: tuple[int, int] = (1, 1), min_df: float | int = 1,
    max_df: float | int = 1.0, max_features: int | None = None, terms: DataFrame | None = None,
) -> DataFrame:
    """(id, term, weight): counts times smoothed idf, each text's weights scaled to length one.

    idf is ``ln((1 + n) / (1 + df)) + 1``. Counts are merged per text before the vocabulary is joined;
    the vocabulary is bounded by ``max_features`` when given, and one of at most ``SENT`` terms is sent to the counts, which then stay where
    their texts lie. Else a term of many texts is split over tasks. A text without kept terms has no rows. ``terms`` may be a vocabulary
    of these texts that is known already, with ``max_features`` as the bound of its size.
    """
    counts = term_counts(df, id_column, text_column, ngram)
    if terms is None:
        terms = vocabulary(counts, df.agg(F.count("*")).scalar(), min_df, max_df, max_features)
    joined = counts.join(F.broadcast(terms), "term") if max_features and max_features <= SENT else join_hot(counts, terms, "term")
    weighted = joined.select(id_column, "term", (F.col("tf") * F.col("idf")).alias("_w"))
    # the window is over the terms of one text
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_column)))
    return weighted.select(id_column, "term", (F.col("_w") / norm).alias("weight"))
