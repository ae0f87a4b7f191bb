"""Writing: appends with generated ids, loads that run once, reloads, exports, manifests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hirelattice.operators.numbering import number_rows
from hirelattice.sources.readers import CORRUPT, good_rows, read_offers_csv


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the target's types and order; absent columns and unreadable values are null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


def append_with_id(target: DataFrame, batch: DataFrame, id_column: str, order: list[str]) -> DataFrame:
    """The batch in the target's columns, numbered after the target's highest id.

    The numbering is a range sort with per-partition offsets, not one global window.
    """
    schema = T.StructType([f for f in target.schema if f.name != id_column])
    numbered = number_rows(cast_to(batch, schema), order, "_rn")
    highest = target.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    return numbered.select((F.col("_rn") + highest).cast("bigint").alias(id_column), *schema.fieldNames())


def has_rows(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(path).limit(1).isEmpty()
    except AnalysisException:
        return False


def load_once(spark: SparkSession, path: str, df: DataFrame) -> bool:
    """Write ``df`` unless the target already has rows; tells whether it wrote."""
    if has_rows(spark, path):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def reload(df: DataFrame, path: str) -> None:
    """Replace the whole content of ``path``; ``df`` must not read from it."""
    df.write.mode("overwrite").parquet(path)


def export_csv_gz(df: DataFrame, path: str, sep: str = ",", single_file: bool = False) -> None:
    """Gzip CSV with a header.

    ``single_file`` writes one part through one task, for small hand-overs only; the default writes
    one part per partition, which any reader of the folder sees as one table.
    """
    out = df.coalesce(1) if single_file else df
    (out.write.mode("errorifexists").option("compression", "gzip").option("header", "true").option("sep", sep)
     .option("quoteAll", "true").option("escape", "\\").option("nullValue", "\\N").csv(path))


@dataclass(frozen=True)
class CsvSource:
    """A delimited file of a manifest with its own schema and dialect."""

    path: str
    schema: T.StructType
    dialect: str = "lenient"

    def read(self, spark: SparkSession) -> DataFrame:
        df = read_offers_csv(spark, self.path, self.schema, self.dialect)
        return good_rows(df) if CORRUPT in df.columns else df


def load_manifest(spark: SparkSession, manifest: dict[str, str | CsvSource], target: str, layers: tuple[str, ...]) -> DataFrame:
    """Load each source of the manifest, a Parquet path or a ``CsvSource``, into every layer once; one report row per (layer, table)."""
    report = []
    for name, source in manifest.items():
        df = source.read(spark) if isinstance(source, CsvSource) else spark.read.parquet(source)
        for layer in layers:
            wrote = load_once(spark, f"{target}/{layer_path(layer, name)}", df)
            report.append((layer, name, wrote, spark.read.parquet(f"{target}/{layer_path(layer, name)}").count()))
    return spark.createDataFrame(report, "layer string, table_name string, written boolean, n_rows bigint")


def layer_path(layer: str | None, name: str, default: str = "silver") -> str:
    """Route a table to its layer's folder; without a layer the default one is taken."""
    return f"{(layer or default).strip().lower()}/{name.lower()}"
