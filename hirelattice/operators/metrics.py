"""Metrics of a matching run, as aggregates over its hit table (query_id, rank, offer_id, similarity)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hirelattice.session import cut

# Weights of the composite quality and of the combined score, time scale, threshold.
QUALITY_WEIGHTS = {"mean_similarity": 0.4, "diversity": 0.3, "coverage": 0.2, "computation_time": 0.1}
SCORE_WEIGHTS = {"text": 0.6, "skills": 0.3, "experience": 0.1}
TIME_SCALE = 2.0
QUALITY_THRESHOLD = 0.7


def _discount(rank: Column) -> Column:
    return F.log2(rank + F.lit(1.0))


def hit_metrics(hits: DataFrame, threshold: float, k: int = 5) -> DataFrame:
    """recall@1, recall@k, precision@k, MRR and nDCG@k, where a hit is a similarity from the threshold on.

    Precision always divides by ``k``; MRR looks at all ranks and averages over queries with a hit
    only; nDCG is 0 for a query without a hit.
    """
    relevant = F.col("similarity") >= threshold
    early = relevant & (F.col("rank") <= k)
    per_query = hits.groupBy("query_id").agg(
        F.max((relevant & (F.col("rank") == 1)).cast("int")).alias("r1"), F.max(early.cast("int")).alias("rk"),
        F.count_if(early).alias("n"), F.min(F.when(relevant, F.col("rank"))).alias("first"),
        F.sum(F.when(early, 1 / _discount(F.col("rank"))).otherwise(0.0)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("n").cast("int"), F.lit(1))), F.lit(0.0),
                        lambda total, i: total + 1 / _discount(i))
    return per_query.agg(
        F.avg("r1").alias("recall_at_1"), F.avg("rk").alias("recall_at_k"), (F.avg("n") / k).alias("precision_at_k"),
        F.avg(1 / F.col("first")).alias("mrr"), F.avg(F.when(F.col("n") > 0, F.col("dcg") / ideal).otherwise(0.0)).alias("ndcg"))


def precision_at_k(hits: DataFrame, truth: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, precision): found true offers among the first ``k``, over min(k, number of true offers).

    ``truth`` holds (query_id, n_true); the hits carry a boolean ``relevant``.
    """
    found = hits.filter(F.col("rank") <= k).groupBy("query_id").agg(F.count_if("relevant").alias("_n"))
    return truth.filter("n_true > 0").join(found, "query_id", "left").select(
        "query_id", (F.coalesce("_n", F.lit(0)) / F.least(F.lit(k), F.col("n_true"))).alias("precision"))


def ndcg_of(rows: DataFrame, keys: list[str], score: str, *also: Column) -> DataFrame:
    """The keys, nDCG of each group in order of ``rank`` with gain ``2^score - 1``, and the aggregates of ``also``; the ideal order is the same scores, sorted."""
    gain = F.pow(F.lit(2.0), F.col(score)) - 1
    summed = rows.groupBy(*keys).agg(
        F.sum(gain / _discount(F.col("rank"))).alias("dcg"), F.sort_array(F.collect_list(gain), asc=False).alias("_g"), *also)
    terms = F.transform("_g", lambda g, i: g / _discount(i + 1))
    ideal = F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
    return summed.withColumn("ndcg", F.when(ideal > 0, F.col("dcg") / ideal).otherwise(F.lit(0.0))).drop("dcg", "_g")


def ndcg_at_k(hits: DataFrame, k: int = 5, score: str = "similarity") -> DataFrame:
    """(query_id, ndcg) of the first ``k`` hits."""
    return ndcg_of(hits.filter(F.col("rank") <= k), ["query_id"], score)


def composite_quality(stats: DataFrame, above: DataFrame, n_corpus: Column, seconds: float) -> DataFrame:
    """The four parts and their weighted sum; the run's seconds are given, so that it can be repeated.

    ``stats`` holds (query_id, mean, std, best), ``above`` (query_id, n) with similarities strictly
    above the threshold.
    """
    w = QUALITY_WEIGHTS
    parts = stats.join(above, "query_id").withColumn("_m", n_corpus).agg(
        F.avg("best").alias("mean_similarity"), F.avg("std").alias("diversity"),
        (F.sum("n") / (F.count("*") * F.max("_m"))).alias("coverage"), F.lit(min(1.0, TIME_SCALE / seconds)).alias("computation_time"))
    total = sum((F.lit(weight) * F.col(name) for name, weight in w.items()), F.lit(0.0))
    return parts.withColumn("quality", total)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def combine_scores(text: Column, skills: Column, experience: Column) -> Column:
    """0.6 text + 0.3 skills + 0.1 experience."""
    w = SCORE_WEIGHTS
    return text * F.lit(w["text"]) + skills * F.lit(w["skills"]) + experience * F.lit(w["experience"])


def similarity_summary(best: DataFrame, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Mean and spread of the best similarities, and the share above the threshold."""
    return best.agg(F.avg("similarity").alias("mean"), F.stddev_pop("similarity").alias("std"),
                    F.avg((F.col("similarity") > threshold).cast("int")).alias("share_above"))


def diversity(hits: DataFrame, n_corpus: Column) -> DataFrame:
    """Distinct recommended offers over the corpus size, and the average similarity."""
    return hits.agg((F.count_distinct("offer_id") / n_corpus).alias("diversity"), F.avg("similarity").alias("avg_similarity"))


def weighted_precision_recall(votes: DataFrame) -> DataFrame:
    """Precision and recall per true label, averaged with the labels' frequencies; ``votes`` is (label, predicted)."""
    # a small table, read three times
    cells = cut(votes.groupBy("label", "predicted").agg(F.count("*").alias("n")))
    support = cells.groupBy("label").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"))
    called = cells.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("called"))
    rows = support.join(called, "label", "left")
    weight = F.col("support") / cells.agg(F.sum("n")).scalar()
    per = rows.select(weight.alias("w"), F.coalesce(F.col("tp") / F.col("called"), F.lit(0.0)).alias("p"), (F.col("tp") / F.col("support")).alias("r"))
    return per.agg(F.sum(F.col("w") * F.col("p")).alias("precision"), F.sum(F.col("w") * F.col("r")).alias("recall"))


def neighbour_vote(hits: DataFrame, labels: DataFrame) -> DataFrame:
    """(query_id, predicted): the most frequent label among a query's neighbours, ties to the lowest label."""
    named = hits.join(labels.select(F.col("id").alias("offer_id"), "label"), "offer_id")
    counts = named.groupBy("query_id", "label").agg(F.count("*").alias("n"))
    return counts.groupBy("query_id").agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("predicted"))


def non_zero_ratio(hits: DataFrame) -> DataFrame:
    return hits.agg(F.avg((F.col("similarity") != 0).cast("int")).alias("non_zero_ratio"))
