"""Dictionary matching: labels that stand between blanks in a text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F


def _spans(parts: Column, words: int) -> Column:
    """All runs of ``words`` blank-separated pieces with a blank on both sides, joined again.

    Splitting at single blanks keeps empty pieces, so runs with inner double blanks stay exact.
    """
    # neither the first nor the last piece has a blank on both sides
    last = F.size(parts) - words
    if words == 1:
        return F.when(last > 1, F.slice(parts, 2, last - 1)).otherwise(F.array().cast("array<string>"))
    return F.when(
        last > 1, F.transform(F.sequence(F.lit(2), last), lambda i: F.array_join(F.slice(parts, i, words), " "))
    ).otherwise(F.array().cast("array<string>"))


def dictionary_match(
    offers: DataFrame, labels: DataFrame, label: str, texts: list[str], keep: list[str], wildcards: bool = False
) -> DataFrame:
    """(kept offer columns, label columns) for every label found, space-delimited, in any text column.

    Each text is cut into runs of as many pieces as the labels have, made distinct within the row,
    and joined to the labels by equality: nothing is compared pair by pair. A label at the very start
    or end of a text, or next to punctuation, is not found. With ``wildcards`` the labels that hold
    ``%`` or ``_`` are matched as patterns in a separate, pair-wise branch.
    """
    is_pattern = F.col(label).rlike("[%_]") if wildcards else F.lit(False)
    plain = labels.filter(~is_pattern).withColumn("_label", F.lower(label))
    # one small row per distinct word count
    counts = sorted(r[0] for r in plain.select(F.size(F.split("_label", " "))).filter(F.col(label).isNotNull()).distinct().collect())
    # the pieces are a column of their own, so that they are cut once per row and not once per run
    pieces = {c: f"_parts_{c}" for c in texts}
    split = offers.select(*keep, *[F.split(F.lower(c), " ").alias(p) for c, p in pieces.items()])
    runs = [F.coalesce(_spans(F.col(p), n), F.array().cast("array<string>")) for p in pieces.values() for n in counts]
    cut = split.select(*keep, F.explode(F.array_distinct(F.concat(*runs)) if runs else F.array().cast("array<string>")).alias("_label"))
    found = cut.join(plain, "_label").drop("_label")
    if not wildcards:
        return found
    patterns = labels.filter(is_pattern).withColumn("_like", F.concat(F.lit("% "), F.lower(label), F.lit(" %")))
    hit = reduce(or_, [F.coalesce(F.expr(f"lower({c}) like _like"), F.lit(False)) for c in texts])
    extra = offers.join(patterns, hit).select(*keep, *labels.columns)
    return found.select(*keep, *labels.columns).unionByName(extra)
