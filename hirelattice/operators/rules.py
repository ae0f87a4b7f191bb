"""Best label per offer by keyword rules."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, functions as F

from hirelattice.operators.dedup import dedup_rank
from hirelattice.operators.rule_data import RuleSet

MAX_LABELS = 1000


def _found(lowered: dict[str, Column], field: str, keywords) -> Column:
    """Any keyword in the field; a null field finds nothing."""
    return F.coalesce(reduce(or_, [F.contains(lowered[field], F.lit(k)) for k in keywords]), F.lit(False))


def _fields(rules: RuleSet) -> list[str]:
    return sorted({rules.exact_field, rules.partial_field, *(f for r in rules.rules for f in r.keywords)})


def rule_match(offers: DataFrame, labels: list[tuple[int, str]], rules: RuleSet, id_column: str) -> DataFrame:
    """Add the id of the best label to each offer, null when nothing hits.

    A label hits by its own text in the exact or the partial field or by its rules; labels are
    ranked by exact, partial and then the rules in their order, ties by lowest id. The few labels
    become one score each in a projection: no join, no shuffle. Offers must hold one row per local
    id, as the cleaned offers do.
    """
    if len(labels) > MAX_LABELS:
        raise ValueError("rule matching is for small label dimensions")
    labels = sorted(labels)
    low = {f: F.col(f"_low_{f}") for f in _fields(rules)}
    flag = lambda hit, weight: F.when(hit, F.lit(weight)).otherwise(F.lit(0))
    found = {r.name: F.col(f"_rule_{r.name}") for r in rules.rules}
    scores = []
    for position, (_, label) in enumerate(labels):
        text = label.lower()
        weights = [(_found(low, rules.exact_field, [text]), 1 << (len(rules.rules) + 1)),
                   (_found(low, rules.partial_field, [text]), 1 << len(rules.rules))]
        weights += [(found[r.name], 1 << (len(rules.rules) - 1 - i)) for i, r in enumerate(rules.rules) if text in r.labels]
        total = reduce(add, [flag(hit, w) for hit, w in weights])
        # the position makes ties fall to the lowest id
        scores.append((total, (MAX_LABELS - position)))
    ranked = [F.when(total > 0, total * (MAX_LABELS + 1) + tie) for total, tie in scores]
    ranked = ranked if len(ranked) > 1 else ranked * 2
    marked = offers.withColumns({f"_low_{f}": F.lower(f) for f in _fields(rules)})
    marked = marked.withColumns({
        f"_rule_{r.name}": reduce(or_, [_found(low, f, k) for f, k in r.keywords.items()]) for r in rules.rules})
    winner = F.lit(MAX_LABELS) - F.col("_best") % (MAX_LABELS + 1)
    ids = F.array(*[F.lit(i) for i, _ in labels])
    return (
        marked.withColumn("_best", F.greatest(*ranked))
        .withColumn(id_column, F.get(ids, winner.cast("int")).cast("bigint"))
        .drop("_best", *[f"_low_{f}" for f in _fields(rules)], *[f"_rule_{r.name}" for r in rules.rules])
    )


def rule_match_by_join(offers: DataFrame, dim: DataFrame, label: str, rules: RuleSet, id_column: str) -> DataFrame:
    """The same result by an OR join and a ranking window; kept to check ``rule_match`` against."""
    low = {f: F.lower(f"o.{f}") for f in _fields(rules)}
    text = F.lower(F.col(f"d.{label}"))
    flags = [F.contains(low[rules.exact_field], text), F.contains(low[rules.partial_field], text)]
    flags += [
        text.isin(*r.labels) & reduce(or_, [_found(low, f, k) for f, k in r.keywords.items()]) for r in rules.rules]
    flags = [F.coalesce(f, F.lit(False)) for f in flags]
    joined = offers.alias("o").join(dim.alias("d"), reduce(or_, flags), "left")
    marked = joined.select("o.*", f"d.{id_column}", *[F.coalesce(f, F.lit(False)).alias(f"_f{i}") for i, f in enumerate(flags)])
    order = [F.col(f"_f{i}").desc() for i in range(len(flags))] + [F.col(id_column).asc_nulls_last()]
    return dedup_rank(marked, ["id_local"], order).drop(*[f"_f{i}" for i in range(len(flags))])
