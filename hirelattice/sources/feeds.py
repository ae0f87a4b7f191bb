"""Nested API payloads to the canonical offer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The canonical offer.
CANONICAL = {
    "id": "string", "source": "string", "title": "string", "description": "string",
    "company_name": "string", "location_name": "string", "contract_type": "string",
    "salary_min": "double", "salary_max": "double", "application_url": "string",
    "date_created": "timestamp", "date_extraction": "timestamp",
}

_LABEL = T.StructType([T.StructField("display_name", T.StringType())])

FEED_ONE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("created", T.StringType()),
    T.StructField("location", _LABEL), T.StructField("company", _LABEL),
    T.StructField("salary_min", T.DoubleType()), T.StructField("salary_max", T.DoubleType()),
    T.StructField("contract_type", T.StringType()), T.StructField("redirect_url", T.StringType()),
])

FEED_TWO = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("intitule", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("dateCreation", T.StringType()),
    T.StructField("lieuTravail", T.StructType([T.StructField("libelle", T.StringType())])),
    T.StructField("entreprise", T.StructType([T.StructField("nom", T.StringType())])),
    T.StructField("typeContrat", T.StringType()),
    T.StructField("contact", T.StructType([T.StructField("urlPostulation", T.StringType())])),
])

# where each canonical attribute is found in the two feeds; absent ones become typed nulls
PATHS_ONE = {
    "id": "id", "title": "title", "description": "description", "company_name": "company.display_name",
    "location_name": "location.display_name", "contract_type": "contract_type", "salary_min": "salary_min",
    "salary_max": "salary_max", "application_url": "redirect_url", "date_created": "created",
}
PATHS_TWO = {
    "id": "id", "title": "intitule", "description": "description", "company_name": "entreprise.nom",
    "location_name": "lieuTravail.libelle", "contract_type": "typeContrat",
    "application_url": "contact.urlPostulation", "date_created": "dateCreation",
}


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 with an optional ``Z``; text that is no date is null and never fails the row."""
    return F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def normalize_source(df: DataFrame, paths: dict[str, str], source: str, extracted_at: Column) -> DataFrame:
    """One feed to the canonical columns, in canonical order and types, so that feeds can be united."""
    out = []
    for name, kind in CANONICAL.items():
        if name == "source":
            value = F.lit(source)
        elif name == "date_extraction":
            value = extracted_at
        elif name not in paths:
            value = F.lit(None)
        elif kind == "timestamp":
            value = iso_timestamp(F.col(paths[name]))
        elif kind == "string":
            value = blank_to_null(F.col(paths[name]).cast("string"))
        else:
            value = F.col(paths[name])
        out.append(value.cast(kind).alias(name))
    return df.select(*out)


def unite(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds; a column missing in one feed is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
