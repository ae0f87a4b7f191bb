"""Candidates: flattening their id arrays and writing their texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def explode_candidates(candidates: DataFrame, arrays: dict[str, str]) -> DataFrame:
    """One row per combination of the ids in the arrays, ``{array column: id column}``.

    A null or empty array gives a null id. The product of the arrays is the source's own row format;
    ``candidate_text`` does not build it.
    """
    return reduce(lambda df, kv: df.withColumn(kv[1], F.explode_outer(kv[0])).drop(kv[0]), arrays.items(), candidates)


def candidate_text(
    candidates: DataFrame, dims: list[tuple[str, DataFrame, str, Column]], keep: list[str] = ["id_candidat", "nom"]
) -> DataFrame:
    """One text per candidate: for every dimension its distinct label texts, sorted and joined by blanks.

    ``dims`` lists (array column, dimension, dimension id, label expression). The ids of all arrays
    are unnested into one long relation and all labels are looked up in one join and one aggregate,
    in place of one join and one aggregate per dimension.
    """
    def tag(array: str, i: int) -> Column:
        ids = F.coalesce(F.col(array), F.array().cast("array<int>"))
        return F.transform(ids, lambda x: F.struct(F.lit(i).alias("dim"), x.cast("bigint").alias("id")))

    tagged = F.concat(*[tag(array, i) for i, (array, *_) in enumerate(dims)])
    long = candidates.select(*keep, F.explode_outer(F.array_distinct(tagged)).alias("_t")).select(*keep, "_t.dim", "_t.id")
    labels = reduce(DataFrame.unionByName, [
        dim.select(F.lit(i).alias("dim"), F.col(id_column).cast("bigint").alias("id"), label.alias("_label"))
        for i, (_, dim, id_column, label) in enumerate(dims)])
    parts = [
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("dim") == i, F.col("_label")))), " ") for i in range(len(dims))]
    return long.join(labels, ["dim", "id"], "left").groupBy(*keep).agg(F.concat_ws(" ", *parts).alias("text"))
