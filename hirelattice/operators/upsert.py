"""Keyed maintenance of stored tables: upsert, update, patch, delete, with schema changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hirelattice.operators.dedup import dedup_rank


def align(target: DataFrame, batch: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """Both sides in the columns the result will have.

    ``append_new`` keeps old columns and adds new ones; ``sync_all`` takes the batch's columns.
    """
    if mode == "append_new":
        names = target.columns + [c for c in batch.columns if c not in target.columns]
    elif mode == "sync_all":
        names = batch.columns
    else:
        raise ValueError(f"unknown schema mode {mode!r}")
    types = {f.name: f.dataType for df in (batch, target) for f in df.schema}

    def fit(df):
        return df.select(*[
            (F.col(c).cast(types[c]) if c in df.columns else F.lit(None).cast(types[c])).alias(c) for c in names])

    return fit(target), fit(batch)


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], schema_mode: str = "append_new", order: list | None = None
) -> DataFrame:
    """The target with the batch's rows in place of its own rows of the same key.

    A key repeated inside the batch needs ``order``: its first row wins. Without it repeated keys
    all stay, which is the source's delete-and-insert behaviour.
    """
    rows = dedup_rank(batch, keys, order) if order else batch
    old, new = align(target, rows, schema_mode)
    touched = new.select(*keys).distinct()
    return old.join(touched, keys, "left_anti").select(*old.columns).unionByName(new)


def insert(target: DataFrame, batch: DataFrame) -> DataFrame:
    old, new = align(target, batch, "append_new")
    return old.unionByName(new)


def _one_each(changes: DataFrame, key: str, order: list | None) -> DataFrame:
    """One change per key, the first in ``order``; without an order a repeated key is an error. Null keys name no row."""
    named = changes.filter(F.col(key).isNotNull())
    if order:
        return dedup_rank(named, [key], order)
    alone = F.count("*").over(Window.partitionBy(key)) == 1
    repeated = F.raise_error(F.concat(F.lit(f"{key} is repeated in the changes: "), F.col(key).cast("string")))
    return named.withColumn(key, F.when(alone, F.col(key)).otherwise(repeated))


def update(target: DataFrame, changes: DataFrame, key: str, order: list | None = None) -> DataFrame:
    """Replace all changed columns of the rows named by ``changes``, nulls included."""
    names = [c for c in changes.columns if c != key]
    new = _one_each(changes, key, order).select(key, *[F.col(c).alias(f"_new_{c}") for c in names], F.lit(True).alias("_hit"))
    joined = target.join(new, key, "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
        for c in target.columns])


def patch(target: DataFrame, changes: DataFrame, key: str, order: list | None = None) -> DataFrame:
    """Replace only the values that ``changes`` supplies."""
    names = [c for c in changes.columns if c != key]
    new = _one_each(changes, key, order).select(key, *[F.col(c).alias(f"_new_{c}") for c in names])
    joined = target.join(new, key, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in names else F.col(c) for c in target.columns])


def delete_by(target: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(ids.select(*keys).distinct(), keys, "left_anti")


def not_found(target: DataFrame, requested: DataFrame, key: str) -> DataFrame:
    """The requested ids the target does not hold."""
    return requested.select(key).distinct().join(target.select(key), key, "left_anti")
