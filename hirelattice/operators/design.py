"""Skill gaps, training suggestions, market weights and trends, attractiveness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hirelattice.operators.dedup import dedup_rank

# trainings of one skill in one row
LISTED = 4096


def missing_skills(pairs: DataFrame, offer_skills: DataFrame, candidate_skills: DataFrame) -> DataFrame:
    """(id_candidat, id_offre, id_competence) for every skill an offer of the pair asks for and the candidate lacks."""
    needed = pairs.select("id_candidat", "id_offre").join(offer_skills, "id_offre")
    return needed.join(candidate_skills, ["id_candidat", "id_competence"], "left_anti")


def skill_score(pairs: DataFrame, offer_skills: DataFrame, candidate_skills: DataFrame) -> DataFrame:
    """(id_candidat, id_offre, score): the share of the offer's skills that the candidate has."""
    held = candidate_skills.withColumn("_has", F.lit(1))
    needed = pairs.select("id_candidat", "id_offre").join(offer_skills, "id_offre")
    return needed.join(held, ["id_candidat", "id_competence"], "left").groupBy("id_candidat", "id_offre").agg(
        (F.count("_has") / F.count("*")).alias("score"))


def suggest_training(missing: DataFrame, training_skills: DataFrame, top: int = 1) -> DataFrame:
    """(id_candidat, id_offre, id_formation, covered, rank): the trainings covering most missing skills.

    Ties fall to the lowest training id. Pairs that lack the same skills get the same answer, so it is
    worked out once per distinct set of skills. What is shuffled is a skill's trainings as lists of at
    most ``LISTED``; they are opened where the rows of a set already lie together, and counted there.
    """
    sets = missing.groupBy("id_candidat", "id_offre").agg(F.array_sort(F.collect_set("id_competence")).alias("_set"))
    # a set goes by the digest of its sorted ids, which is shorter to shuffle and sort than the set
    sets = sets.withColumn("_key", F.unhex(F.md5(F.array_join("_set", ","))))
    distinct = sets.select("_key", "_set").dropDuplicates(["_key"])
    place = F.row_number().over(Window.partitionBy("id_competence").orderBy("id_formation")) - 1
    lists = training_skills.select("id_competence", "id_formation", F.floor(place / LISTED).alias("_list")).groupBy("id_competence", "_list").agg(
        F.collect_list("id_formation").alias("_trainings"), F.count("*").alias("_n"))
    # a training without an id counts too, which a list would leave out
    lists = lists.select("id_competence", F.concat("_trainings", F.array_repeat(F.lit(None), (F.col("_n") - F.size("_trainings")).cast("int"))).alias("_trainings"))
    covered = distinct.select("_key", F.explode("_set").alias("id_competence")).join(lists, "id_competence").select("_key", "_trainings")
    # as many parts as a shuffle has, though few bytes come in: the opened lists are many times that
    parts = int(missing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = covered.repartition(parts, "_key").select("_key", F.explode("_trainings").alias("id_formation")).groupBy("_key", "id_formation").agg(F.count("*").alias("covered"))
    best = dedup_rank(counts, ["_key"], [F.col("covered").desc(), F.col("id_formation").asc()], keep=top, rank="rank")
    return sets.drop("_set").join(best, "_key").drop("_key")


def skill_weight(offers: DataFrame, offer_skills: DataFrame, domain: str) -> DataFrame:
    """(domain, id_competence, weight): the share of the domain's offers that ask for the skill."""
    named = offers.select("id_offre", domain)
    sizes = named.groupBy(domain).agg(F.count("*").alias("_offers"))
    held = offer_skills.join(named, "id_offre").groupBy(domain, "id_competence").agg(F.count("*").alias("n"))
    return held.join(sizes, domain).select(domain, "id_competence", (F.col("n") / F.col("_offers")).alias("weight"))


def trend(offers: DataFrame, domain: str, day: str, value: str) -> DataFrame:
    """Per domain and month: offers, mean value and the change against the month before.

    The window runs over months, after the offers are summed up.
    """
    monthly = offers.groupBy(domain, F.date_format(day, "yyyy-MM").alias("month")).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"))
    w = Window.partitionBy(domain).orderBy("month")
    return monthly.withColumns({"change_n": F.col("n") - F.lag("n").over(w), "change_mean": F.col("mean") - F.lag("mean").over(w)})


def attractiveness(offers: DataFrame, weights: dict[str, float], id_column: str) -> DataFrame:
    """(id, score): weighted sum of the columns, each scaled to [0, 1] over all offers; null counts as 0.

    The least and greatest values are one row, found in one pass.
    """
    ends = offers.agg(F.struct(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in weights]).alias("e"))
    rows = offers.withColumn("_e", ends.scalar())

    def scaled(c: str) -> Column:
        lo, hi = F.col("_e")[c]["lo"], F.col("_e")[c]["hi"]
        return F.coalesce(F.when(hi > lo, (F.col(c) - lo) / (hi - lo)), F.lit(0.0))

    return rows.select(id_column, sum((F.lit(w) * scaled(c) for c, w in weights.items()), F.lit(0.0)).alias("score"))
