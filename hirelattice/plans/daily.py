"""The daily batch: from raw offers to the fact, its bridges and the wide table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from hirelattice.operators import rule_data as rd
from hirelattice.operators import star
from hirelattice.operators.bucketed import BucketedTable
from hirelattice.operators.companies import company_match
from hirelattice.operators.dates import date_match
from hirelattice.operators.dedup import clean_offers, dedup_rank
from hirelattice.operators.dictionary import dictionary_match
from hirelattice.operators.domains import domain_match
from hirelattice.operators.places import place_match
from hirelattice.operators.rules import rule_match
from hirelattice.operators.search import day_slice


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables; the three label dimensions are short lists of (id, label)."""

    contracts: list[tuple[int, str]]
    seniorities: list[tuple[int, str]]
    remote_modes: list[tuple[int, str]]
    places: DataFrame
    companies: DataFrame
    calendar: DataFrame
    rome: DataFrame
    domains: DataFrame
    stopwords: DataFrame
    skills: DataFrame


def todays_offers(raw: DataFrame, run_date: str) -> DataFrame:
    """One row per local id, of those whose kept extraction, the oldest, is the run date's.

    Only the day's rows are ranked; of all earlier ones nothing but the local id is read, to leave known offers out.
    """
    first = clean_offers(day_slice(raw, "date_extraction", run_date), keep_rank=False)
    known = raw.filter(F.to_date("date_extraction") < F.lit(run_date).cast("date")).select(F.col("id_local").alias("_known"))
    return first.join(known, F.col("id_local").eqNullSafe(F.col("_known")), "left_anti")


def build_fact(offers: DataFrame, dims: Dimensions) -> DataFrame:
    """One row per offer with the id of its best match in every dimension.

    The label matchers need no other rows, so they are columns of one pass over the offers. The others
    join on the local id, which shuffles the offers once.
    """
    labelled = rule_match(offers, dims.contracts, rd.CONTRACT_RULES, "id_contrat")
    labelled = rule_match(labelled, dims.seniorities, rd.SENIORITY_RULES, "id_seniorite")
    labelled = rule_match(labelled, dims.remote_modes, rd.REMOTE_RULES, "id_teletravail")
    dates = date_match(offers, dims.calendar).select(
        "id_local", F.col("id_date_created").alias("id_date_creation"), F.col("id_date_updated").alias("id_date_modification"))
    # an offer can be both a combined and a sector-only match; the fact has one row per offer
    domains = dedup_rank(domain_match(offers, dims.domains, dims.stopwords).filter("id_local is not null"), ["id_local"],
                         [F.col("id_domaine").asc_nulls_last()]).select("id_local", "id_domaine")
    matches = [
        place_match(offers, dims.places).select("id_local", "id_lieu"),
        company_match(offers, dims.companies).select("id_local", "id_entreprise"),
        domains,
        star.code_match(offers, dims.rome, "code_rome", "code_rome", ["id_local"], "id_rome"),
        dates,
    ]
    return star.assemble_fact(labelled.select("id_offre", "id_local", "id_contrat", "id_seniorite", "id_teletravail"), matches)


def build_skill_bridge(offers: DataFrame, fact: DataFrame, skills: DataFrame) -> DataFrame:
    found = dictionary_match(offers, skills, "skill", ["description", "skills"], ["id_local"])
    return star.offer_bridge(found.select("id_local", "id_competence"), fact, "id_offre", "id_competence")


def run(raw: DataFrame, dims: Dimensions, run_date: str, target: str, buckets: int = 64) -> tuple[DataFrame, DataFrame]:
    """Upsert one day into the stored fact and skill bridge; returns both as they are afterwards.

    Only the buckets that hold the day's keys are written. A day may be run again, also after a run that
    failed. The day's fact is written first and read back, so that the bridge does not work it out again.
    """
    spark = raw.sparkSession
    offers = todays_offers(raw, run_date)
    day = f"{target}/day/{run_date}"
    build_fact(offers, dims).write.mode("overwrite").parquet(day)
    fact_of_day = spark.read.parquet(day)
    bridge_of_day = build_skill_bridge(offers, fact_of_day, dims.skills)
    out = []
    for name, batch, keys, mode in (("fact", fact_of_day, ["id_local"], "append_new"),
                                    ("offer_skill", bridge_of_day, ["id_offre", "id_competence"], "sync_all")):
        table = BucketedTable(spark, f"{target}/{name}", keys, buckets)
        table.upsert(batch, mode)
        out.append(table.read())
    return out[0], out[1]
