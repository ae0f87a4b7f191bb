"""Fact table, bridges and the wide table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hirelattice.session import broadcast_if_small


def assemble_fact(raw: DataFrame, matches: list[DataFrame], key: str = "id_local") -> DataFrame:
    """Left-join every match table to the offers on the local id.

    All joins share one key, so the offers are shuffled once and each match once.
    """
    out = raw
    for match in matches:
        out = out.join(match, key, "left")
    return out


def same_text(left: Column, right: Column) -> Column:
    return F.lower(left) == F.lower(right)


def code_match(offers: DataFrame, dim: DataFrame, code: str, dim_code: str, keep: list[str], dim_id: str) -> DataFrame:
    """Inner join on a code, ignoring case."""
    o, d = offers.alias("o"), dim.alias("d")
    return o.join(d, same_text(F.col(f"o.{code}"), F.col(f"d.{dim_code}"))).select(
        *[F.col(f"o.{c}") for c in keep], F.col(f"d.{dim_id}"))


def bridge(
    raw: DataFrame, left: DataFrame, right: DataFrame, left_on: tuple[str, str], right_on: tuple[str, str],
    left_id: str, right_id: str,
) -> DataFrame:
    """Distinct (left id, right id) pairs of a raw relation that names both sides by text.

    The pairs are made distinct by text first, so repeated raw rows are merged before the joins.
    """
    pairs = raw.select(F.lower(left_on[0]).alias("_l"), F.lower(right_on[0]).alias("_r")).distinct()
    lhs = left.select(F.lower(left_on[1]).alias("_l"), left_id)
    rhs = right.select(F.lower(right_on[1]).alias("_r"), right_id)
    return pairs.join(lhs, "_l").join(rhs, "_r").select(left_id, right_id).distinct()


def offer_bridge(match: DataFrame, fact: DataFrame, fact_id: str, item_id: str, key: str = "id_local") -> DataFrame:
    """(offer id, item id) for every match; the offer id is null when the offer is not in the fact."""
    return match.select(key, item_id).join(fact.select(key, fact_id), key, "left").select(fact_id, item_id)


def join_values(df: DataFrame, keys: list[str], outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """Per key one sorted, distinct, delimited string for each output: ``{name: (column, separator)}``.

    Repeats are merged on the map side; no values gives null, not an empty string.
    """
    return df.groupBy(*keys).agg(*[
        F.nullif(F.array_join(F.array_sort(F.collect_set(F.col(column))), sep), F.lit("")).alias(name)
        for name, (column, sep) in outputs.items()])


def wide_table(
    fact: DataFrame, lookups: list[tuple[DataFrame, str]],
    bridges: list[tuple[DataFrame, str, dict[str, tuple[str, str]]]], naive: bool = False, id_column: str = "id_offre",
) -> DataFrame:
    """The fact with its dimension attributes and each bridge as delimited strings.

    Every bridge is reduced to one row per key before it is joined, so the bridges do not multiply
    each other's rows. Bridges on the offer id go first and share one shuffle of the fact; the others
    hang on small code lists and are broadcast if a count shows them to be small. ``naive`` joins
    first and groups last; it is kept as the measure for that.
    """
    out = fact
    if not naive:
        for rows, key, outputs in bridges:
            if key == id_column:
                out = out.join(join_values(rows, [key], outputs), key, "left")
    for dim, key in lookups:
        out = out.join(dim, key, "left")
    if not naive:
        for rows, key, outputs in bridges:
            if key != id_column:
                out = out.join(broadcast_if_small(join_values(rows, [key], outputs)), key, "left")
        return out
    plain = out.columns
    joined: dict[str, tuple[str, str]] = {}
    for rows, key, outputs in bridges:
        out = out.join(rows.select(key, *{c for c, _ in outputs.values()}), key, "left")
        joined |= outputs
    return join_values(out, plain, joined)
