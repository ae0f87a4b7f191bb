"""Filters, free text, sorting and paging over an offer table, as Column predicates."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

MAX_PAGE_SIZE = 100

_COMPARE = {
    "eq": lambda c, v: c == v, "neq": lambda c, v: c != v,
    "gt": lambda c, v: c > v, "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v,
}


@dataclass(frozen=True)
class Filter:
    field: str
    op: str
    value: Any


@dataclass(frozen=True)
class SearchRequest:
    filters: list[Filter] = field(default_factory=list)
    text: str | None = None
    sort: list[tuple[str, str]] = field(default_factory=list)
    page: int = 1
    size: int = 20


def coerce(value: str) -> int | float | str:
    """Text from a request to int, else float, else text."""
    for kind in (int, float):
        try:
            return kind(value)
        except (TypeError, ValueError):
            continue
    return value


def _contains(column: Column, text: str, wildcards: bool) -> Column:
    """Case-insensitive containment; with ``wildcards``, ``%`` and ``_`` in the text match anything."""
    low = F.lower(column.cast("string"))
    return low.like(f"%{text.lower()}%") if wildcards else low.contains(text.lower())


def one_filter(f: Filter) -> Column:
    c = F.col(f.field)
    if f.op in _COMPARE:
        return _COMPARE[f.op](c, F.lit(f.value))
    if f.op == "like":
        return _contains(c, str(f.value), wildcards=True)
    if f.op == "in":
        if not isinstance(f.value, (list, tuple)):
            raise ValueError(f"{f.field}: 'in' needs a list")
        return c.isin(list(f.value))
    if f.op == "between":
        if not isinstance(f.value, (list, tuple)) or len(f.value) != 2:
            raise ValueError(f"{f.field}: 'between' needs exactly two values")
        return c.between(*[F.lit(v) for v in f.value])
    raise ValueError(f"unknown operator {f.op!r}")


def build_predicate(filters: list[Filter]) -> Column:
    """All filters ANDed. Two filters on one field both apply (the source keeps only the last value)."""
    return reduce(and_, map(one_filter, filters), F.lit(True))


def free_text(columns: list[str], text: str, wildcards: bool = False) -> Column:
    """True where any of the columns holds the text; null columns do not count."""
    return F.coalesce(reduce(or_, [F.coalesce(_contains(F.col(c), text, wildcards), F.lit(False)) for c in columns]),
                      F.lit(False))


def sort_columns(sort: list[tuple[str, str]], id_column: str = "id") -> list[Column]:
    """Request sort to columns: nulls last both ways, highest id first as default and as tie-break."""
    out = [F.col(c).asc_nulls_last() if d.lower() == "asc" else F.col(c).desc_nulls_last() for c, d in sort]
    return [*out, F.col(id_column).desc_nulls_last()]


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1). Offset and limit plan as a partial top-n per task, no full sort."""
    if number < 1 or not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError("page from 1, size from 1 to 100")
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, last_id: int, size: int, id_column: str = "id") -> DataFrame:
    """The next page below the last id seen: the cost does not grow with the page number."""
    return df.filter(F.col(id_column) < last_id).orderBy(F.col(id_column).desc()).limit(size)


def envelope(df: DataFrame, number: int, size: int) -> DataFrame:
    """(total, page, page_size, pages, has_next, has_prev) of the filtered rows."""
    pages = F.ceil(F.col("total") / size).cast("bigint")
    return df.agg(F.count("*").alias("total")).select(
        "total", F.lit(number).cast("bigint").alias("page"), F.lit(size).cast("bigint").alias("page_size"),
        pages.alias("pages"), (F.lit(number) < pages).alias("has_next"), F.lit(number > 1).alias("has_prev"))


def search(
    df: DataFrame, request: SearchRequest, text_columns: list[str], id_column: str = "id", wildcards: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The requested page and its envelope; unknown fields are refused."""
    for name in [f.field for f in request.filters] + [c for c, _ in request.sort]:
        if name not in df.columns:
            raise ValueError(f"unknown field {name!r}")
    hits = df.filter(build_predicate(request.filters))
    if request.text:
        hits = hits.filter(free_text(text_columns, request.text, wildcards))
    order = sort_columns(request.sort, id_column)
    return page(hits, order, request.page, request.size), envelope(hits, request.page, request.size)


@dataclass(frozen=True)
class TermStage:
    """Keep rows where any term occurs in any of the columns; no terms means no condition."""

    terms: list[str]
    columns: list[str]


def multi_term_search(
    df: DataFrame, stages: list[TermStage], location: str | None = None, address: list[str] | None = None,
    one_row_per_term: bool = True, wildcards: bool = True, required_first: bool = True,
) -> DataFrame:
    """Staged search. With ``one_row_per_term`` a row comes back once per matching term of each stage,
    as in the source; without it once.

    The first stage is required when ``required_first`` (no search terms, no rows); later stages with
    no terms let every row pass. The terms are unnested per row, so no join is planned.
    """
    out = df
    for i, stage in enumerate(stages):
        if not stage.terms:
            if i == 0 and required_first:
                return df.filter(F.lit(False))
            continue
        hits = F.array_compact(F.array(*[
            F.when(free_text(stage.columns, term, wildcards), F.lit(term)) for term in stage.terms]))
        if one_row_per_term:
            out = out.withColumn("_term", F.explode(hits)).drop("_term")
        else:
            out = out.filter(F.size(hits) > 0)
    if location is not None:
        where = F.concat_ws(", ", *[F.col(c).cast("string") for c in address or []])
        out = out.filter(_contains(where, location, wildcards))
    return out


def lookup(df: DataFrame, id_column: str, value, newest: str | None = None) -> DataFrame:
    """At most one row with the id, the newest first."""
    hit = df.filter(F.col(id_column) == F.lit(value))
    order = [F.col(newest).desc_nulls_last()] if newest else []
    return hit.orderBy(*order, F.col(id_column).desc()).limit(1)


def listing(df: DataFrame, id_column: str, number: int | None = None, size: int = 20) -> DataFrame:
    """A dimension in id order, whole or one page."""
    order = [F.col(id_column).asc()]
    return df.orderBy(*order) if number is None else page(df, order, number, size)


def day_slice(df: DataFrame, ts_column: str, run_date: str) -> DataFrame:
    """The extraction of one day, as a half-open range on the stored column so that it reaches the scan."""
    lo = F.lit(run_date).cast("date")
    t = F.col(ts_column)
    return df.filter((t >= lo.cast("timestamp")) & (t < F.date_add(lo, 1).cast("timestamp")))


def drop_blank(df: DataFrame, columns: list[str], nulls: str = "keep") -> DataFrame:
    """Drop rows where a column is one blank; nulls stay (data-frame rule) or go (SQL rule)."""
    if nulls == "keep":
        return df.filter(reduce(and_, [F.col(c).isNull() | (F.col(c) != " ") for c in columns]))
    return df.filter(reduce(and_, [F.col(c) != " " for c in columns]))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values, ties by value."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
            .orderBy(F.col("n").desc(), F.col(column).asc()).limit(n))


def semi_top_n(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose value is among the ``n`` most frequent."""
    return df.join(top_values(df, column, n).select(column), column, "left_semi")
