"""Registered queries: one per operator, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hirelattice.plans.bindings import duck_with, spark_binding
from hirelattice.session import prepare, spread

SECTIONS = (
    "sources", "filters", "joins", "matchers", "aggregates", "windows", "scalars",
    "mutations", "text", "similarity", "learning", "streams", "design",
)


# tables of long texts, where the work per row outweighs moving the rows
TEXT_TABLES = ("documents", "pages", "conversations")


@dataclass(frozen=True)
class Entry:
    run: Callable[["Tables"], DataFrame]
    sql: str | None


class Tables:
    """The given tables of one folder, and the relations bound to them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        scan = self.spark.read.parquet(self.path(name))
        return spread(scan) if name in TEXT_TABLES else scan

    def bind(self, name: str) -> DataFrame:
        return spark_binding(self, name)


_REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may name bound relations, which are put in front as CTEs."""

    def register(fn):
        if name in _REGISTRY:
            raise ValueError(f"query {name} registered twice")
        _REGISTRY[name] = Entry(fn, duck_with(sql) if sql else None)
        return fn

    return register


def registry() -> dict[str, Entry]:
    for section in SECTIONS:
        importlib.import_module(f"hirelattice.queries.{section}")
    return _REGISTRY
