"""Keep the first rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def dedup_rank(df: DataFrame, keys: list, order: list, keep: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``keep`` rows per key in ``order``, which must end in a unique column.

    Written as ``row_number() <= keep``: Spark then also cuts each key to ``keep`` rows before the
    shuffle, so a key that holds a third of all rows sends only a few rows per task.
    """
    name = rank or "_rn"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= keep)
    if rank is None:
        return out.drop(name)
    return out.withColumn(name, F.col(name).cast("bigint"))


def clean_offers(raw: DataFrame, keep_rank: bool = True) -> DataFrame:
    """One row per local id: the oldest extraction wins, then the highest offer id.

    The rank column stays in the result, as in the source's table; drop it with ``keep_rank``.
    """
    return dedup_rank(
        raw, ["id_local"], [F.col("date_extraction").asc_nulls_last(), F.col("id_offre").desc_nulls_last()],
        rank="rn" if keep_rank else None,
    )
