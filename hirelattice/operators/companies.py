"""Company matching by exact name or first word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Size classes in falling priority.
SIZE_ORDER = ("GE", "ETI", "PME")


def first_word(name: Column) -> Column:
    return F.lower(F.split(F.trim(name), " ")[0])


def company_match(
    offers: DataFrame, companies: DataFrame, size_order: tuple[str, ...] = SIZE_ORDER, name: str = "company_name"
) -> DataFrame:
    """Add ``id_entreprise`` and ``nom_entreprise`` of the best company to each offer.

    Order: same name (ignoring case), then same first word of the trimmed name, then size class,
    then lowest register number. Both ways to match are equalities, and equal names always share
    their first word, so the register is first reduced to its best company per name and per first
    word. Each offer then meets at most one row in each of two equi joins, however common a word is.
    """
    size = F.coalesce(*[F.when(F.col("categorie_entreprise") == s, F.lit(i)) for i, s in enumerate(size_order)],
                      F.lit(len(size_order)))
    best = F.min(F.struct(size.alias("size"), F.col("siren"), F.col("nom_entreprise")))
    by_name = (companies.filter("nom_entreprise is not null").groupBy(F.lower("nom_entreprise").alias("_name"))
               .agg(best.alias("_by_name")))
    by_word = (companies.filter("nom_entreprise is not null").groupBy(first_word(F.col("nom_entreprise")).alias("_word"))
               .agg(best.alias("_by_word")))
    won = F.coalesce("_by_name", "_by_word")
    # the digest as a further key makes Spark deal out the register anew too, so that it can split a word many offers share
    by_name = by_name.withColumn("_name_digest", F.xxhash64("_name"))
    by_word = by_word.withColumn("_word_digest", F.xxhash64("_word"))
    return (
        offers.withColumns({"_name": F.lower(name), "_word": first_word(F.col(name))})
        .withColumns({"_name_digest": F.xxhash64("_name"), "_word_digest": F.xxhash64("_word")})
        .join(by_name, ["_name_digest", "_name"], "left").join(by_word, ["_word_digest", "_word"], "left")
        .withColumns({"id_entreprise": won["siren"], "nom_entreprise": won["nom_entreprise"]})
        .drop("_name", "_word", "_name_digest", "_word_digest", "_by_name", "_by_word")
    )
