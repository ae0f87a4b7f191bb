"""Reading offers: CSV dialects, Parquet with a schema report, dated drops, self-describing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

# The text that stands for null in the feeds, and the texts that do so in the daily drop.
NULL_MARK = r"\N"
NULL_TEXTS = ("NULL", "null", "")

CORRUPT = "_corrupt"


def read_offers_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, dialect: str = "strict", names: list[str] | None = None
) -> DataFrame:
    """The offers of some files or folders, as ``parse_csv`` reads them."""
    return parse_csv(spark.read, path, schema, dialect, names)


def parse_csv(
    reader: DataFrameReader | DataStreamReader, path: str | list[str], schema: T.StructType, dialect: str = "strict", names: list[str] | None = None
) -> DataFrame:
    """Read delimited offers, plain or compressed, with an explicit schema (no inference pass over the data).

    ``strict``   comma, optional double quote, header skipped, ``\\N`` is null; a row with another
                 number of columns is an error.
    ``lenient``  empty text, ``NULL``, ``null`` and ``\\N`` are null; short and long rows are kept.
    ``quoted``   every field quoted, backslash escapes, line breaks inside fields; rows that cannot
                 be read are kept apart in ``_corrupt``; ``names`` replaces the header.
    """
    reader = reader.option("header", "true").option("quote", '"')
    if dialect == "strict":
        # nulls are marked, so that an empty text stays an empty text
        return reader.option("nullValue", NULL_MARK).option("emptyValue", "").option("mode", "FAILFAST").schema(schema).csv(path)
    if dialect == "lenient":
        df = reader.option("nullValue", NULL_MARK).option("mode", "PERMISSIVE").schema(schema).csv(path)
        texts = {f.name for f in schema if isinstance(f.dataType, T.StringType)}
        return df.select(*[F.when(~F.col(c).isin(*NULL_TEXTS), F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns])
    if dialect == "quoted":
        with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        df = (
            reader.option("escape", "\\").option("multiLine", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(with_bad).csv(path)
        )
        return df.toDF(*names, CORRUPT) if names else df
    raise ValueError(f"unknown dialect {dialect!r}")


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


# The type names the loader reports for a Parquet column.
TYPE_NAMES = {
    "tinyint": "NUMBER", "smallint": "NUMBER", "int": "NUMBER", "bigint": "NUMBER",
    "float": "FLOAT", "double": "FLOAT", "date": "DATE", "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "string": "VARCHAR",
}


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, type, known values) of a table, counted in one pass over its columns."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    entries = F.array(*[
        F.struct(F.lit(i + 1).cast("bigint").alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(TYPE_NAMES.get(f.dataType.simpleString(), "VARIANT")).alias("type_name"), F.col(f.name).alias("n_known"))
        for i, f in enumerate(df.schema)])
    return counts.select(F.explode(entries).alias("e")).select("e.*")


def drops(spark: SparkSession, folder: str, pattern: str = r"_(\d{8}_\d{4})_", ts_format: str = "yyyyMMdd_HHmm") -> DataFrame:
    """(path, dropped_at) of all files below a folder, from their names alone; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    stamp = F.try_to_timestamp(F.nullif(F.regexp_extract("path", pattern, 1), F.lit("")), F.lit(ts_format))
    # files with an unreadable date come before all others
    return files.withColumn("dropped_at", F.coalesce(stamp, F.lit("0001-01-01").cast("timestamp")))


def latest_drop(spark: SparkSession, folder: str, **options) -> list[str]:
    """The paths of the newest dated drop: the file names of one delivery."""
    found = drops(spark, folder, **options)
    newest = found.filter(F.col("dropped_at") == found.agg(F.max("dropped_at")).scalar())
    return [r["path"] for r in newest.select("path").orderBy("path").collect()]


def parse_id_arrays(df: DataFrame, columns: list[str]) -> DataFrame:
    """JSON text such as ``[450, 1117]`` to arrays of ids; ``[]`` stays empty, null stays null."""
    return df.withColumns({c: F.from_json(F.col(c), "array<int>") for c in columns})


def discover_columns(df: DataFrame, json_column: str) -> DataFrame:
    """Every (key, type) of the top-level objects in a JSON text column, with how many rows hold it.

    Grouping by key and type is combined on the map side, so a key held by every row costs one row
    per task in the shuffle.
    """
    pairs = df.select(F.explode(F.from_json(F.col(json_column), "map<string,string>")).alias("key", "value"))
    value = F.col("value")
    kind = (
        F.when(value.isNull(), "NULL")
        .when(value.isin("true", "false"), "BOOLEAN")
        .when(value.try_cast("bigint").isNotNull(), "INTEGER")
        .when(value.try_cast("double").isNotNull(), "DOUBLE")
        .when(value.startswith("{"), "OBJECT")
        .when(value.startswith("["), "ARRAY")
        .otherwise("VARCHAR")
    )
    return pairs.groupBy("key", kind.alias("type_name")).agg(F.count("*").alias("n_rows"))


def project_discovered(df: DataFrame, json_column: str, columns: dict[str, str], keep: list[str]) -> DataFrame:
    """One typed column per discovered key; values that do not fit the type become null."""
    parsed = F.from_json(F.col(json_column), "map<string,string>")
    return df.withColumn("_m", parsed).select(
        *keep, *[F.col("_m")[k].try_cast(t).alias(k) for k, t in columns.items()]
    )
