"""Activity domain of an offer from the words its sector and description share with the domain names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from hirelattice.operators.dedup import dedup_rank
from hirelattice.operators.tokens import exploded, not_in, split_tokens, token_counts
from hirelattice.session import cut

# (domain, token) rows that one lookup table holds; more domain names make more tables, each read in the row
NAMES = 100_000
# stop words that are sent to the tasks
MAX_STOPWORDS = 100_000

_FOUND = "struct<total:bigint,found:array<struct<id_domaine:bigint,matched_tokens:bigint,unique_matched_tokens:bigint,tokens:array<string>>>>"


def _domain_tokens(domains: DataFrame, stopwords: DataFrame) -> DataFrame:
    return token_counts(domains.filter("id_domaine is not null"), "id_domaine", "nom_domaine", stopwords).withColumnRenamed("n", "_n")


def _lookup(names: list, stop: list[str], min_length: int):
    """A function of token arrays: the distinct tokens that count, and per domain the tokens shared with its name."""
    names = sorted((r["token"], r["id_domaine"], r["_n"]) for r in names)
    keys = sorted({token for token, _, _ in names})
    first = np.append(np.searchsorted(np.array([t for t, _, _ in names], object), np.array(keys, object)), len(names)).astype(np.int64)
    ids, times = (np.array([r[i] for r in names], np.int64) for i in (1, 2))

    def match(tokens: pa.Array) -> pa.Array:
        words, known_keys = pa.array(stop, pa.string()), pa.array(keys, pa.string())
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        coded = tokens.flatten().dictionary_encode()
        word = coded.dictionary
        width = max(1, len(word))
        # one entry for each distinct token of a row
        each, n = np.unique(np.repeat(np.arange(len(tokens)), sizes) * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        row, code = each // width, each % width
        counts = pc.and_(pc.greater_equal(pc.utf8_length(word), min_length), pc.invert(pc.is_in(word, value_set=words)))
        total = np.bincount(row[counts.to_numpy(zero_copy_only=False)[code]], minlength=len(tokens))
        key = pc.fill_null(pc.index_in(word, value_set=known_keys), -1).to_numpy(zero_copy_only=False)[code].astype(np.int64)
        hit = key >= 0
        row, key, n = row[hit], key[hit], n[hit]
        homes = first[key + 1] - first[key]
        at = np.repeat(np.arange(len(key)), homes)
        place = first[key][at] + np.arange(len(at)) - np.repeat(np.cumsum(homes) - homes, homes)
        order = np.lexsort((key[at], ids[place], row[at]))
        row, key, domain, n = row[at][order], key[at][order], ids[place][order], (times[place] * n[at])[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (domain[1:] != domain[:-1])
        start = np.flatnonzero(new)
        edges = np.append(start, len(row))
        run = np.concatenate([[0], np.cumsum(n)])
        shared = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), known_keys.take(pa.array(key)))
        found = pa.StructArray.from_arrays(
            [pa.array(domain[start]), pa.array(np.diff(run[edges])), pa.array(np.diff(edges)), shared],
            names=["id_domaine", "matched_tokens", "unique_matched_tokens", "tokens"])
        per_row = np.searchsorted(row[start], np.arange(len(tokens) + 1))
        return pa.StructArray.from_arrays(
            [pa.array(total.astype(np.int64)), pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), found)], names=["total", "found"])

    return F.arrow_udf(match, _FOUND)


def _finder(names: DataFrame, stopwords: DataFrame, min_length: int = 3):
    """A function of a text column: its number of distinct tokens that count, and its matches by domain, in order of the domain.

    The domain names' tokens are looked up inside the offer's row, so no offer is shuffled and no pair of an offer and
    a domain is a row. The names are handed out in tables of about ``NAMES`` entries, each domain whole in one of them.
    """
    tables = max(1, -(-names.count() // NAMES))
    stop = [r[0] for r in stopwords.select("word").filter("word is not null").distinct().limit(MAX_STOPWORDS + 1).collect()]
    if len(stop) > MAX_STOPWORDS:
        raise ValueError(f"at most {MAX_STOPWORDS} stop words")
    looks = []
    for k in range(tables):
        mine = names.filter(F.pmod(F.xxhash64("id_domaine"), F.lit(tables)) == k) if tables > 1 else names
        looks.append(_lookup(mine.collect(), stop, min_length))

    def find(text: Column) -> Column:
        pieces = F.transform(split_tokens(text), F.trim)
        if tables == 1:
            return looks[0](pieces)
        parts = [look(pieces) for look in looks]
        return F.struct(parts[0]["total"].alias("total"), F.flatten(F.array(*[p["found"] for p in parts])).alias("found"))

    return find


def _matches(domains: DataFrame, offers: DataFrame, text: str, stopwords: DataFrame) -> DataFrame:
    """Per (domain, offer) with a shared token the counts, and domain tokens without an offer under a null offer."""
    d = cut(_domain_tokens(domains, stopwords))
    find = _finder(d, stopwords)
    rows = offers.select("id_local", find(F.col(text)).alias("_m")).select("id_local", F.col("_m.total").alias("total_tokens"), F.explode("_m.found").alias("_f"))
    kind = d.schema["id_domaine"].dataType
    matched = rows.select(
        F.col("_f.id_domaine").cast(kind).alias("id_domaine"), "id_local", F.col("_f.matched_tokens").alias("matched_tokens"),
        F.col("_f.unique_matched_tokens").alias("unique_matched_tokens"), F.array_join("_f.tokens", " ").alias("matching_tokens"), "total_tokens")
    # distinct is combined on the map side: at most as many rows per task as there are domain tokens
    used = exploded(offers, "id_local", text).join(d.select("token").distinct(), "token", "left_semi").select("token").distinct()
    unmatched = d.join(used, "token", "left_anti").groupBy("id_domaine").agg(F.sum("_n").alias("matched_tokens")).select(
        "id_domaine", F.lit(None).cast("string").alias("id_local"), "matched_tokens", F.lit(0).cast("bigint").alias("unique_matched_tokens"),
        F.lit(None).cast("string").alias("matching_tokens"), F.lit(None).cast("bigint").alias("total_tokens"))
    return matched.unionByName(unmatched)


def token_matches(domains: DataFrame, offers: DataFrame, text: str, stopwords: DataFrame) -> DataFrame:
    """Per (domain, offer) the shared tokens: all, distinct and listed; ``offers`` has one row per local id.

    Stop words and short tokens need no test on the offers' side, since the domain side has none. Domain
    tokens without an offer stay, under a null offer; domains without an id are left out.
    """
    return _matches(domains, offers, text, stopwords).drop("total_tokens")


def total_tokens(offers: DataFrame, text: str, stopwords: DataFrame, min_length: int = 3) -> DataFrame:
    """Distinct tokens per offer; offers with the same text have the same count.

    Tokens are made distinct inside the row, so only one row per offer is shuffled.
    """
    words = stopwords.select(F.col("word").alias("token")).filter("token is not null").distinct()
    pieces = offers.select("id_local", F.explode(F.array_distinct(F.transform(split_tokens(F.col(text)), F.trim))).alias("token"))
    kept = pieces.filter(F.length("token") >= min_length).join(words, "token", "left_anti")
    return kept.groupBy("id_local").agg(F.count("*").alias("total_tokens"))


def scored_matches(domains: DataFrame, offers: DataFrame, text: str, stopwords: DataFrame) -> DataFrame:
    """Token matches with the share of the offer's distinct tokens that was found, in percent."""
    return _matches(domains, offers, text, stopwords).withColumn("pct", _percent(F.col("unique_matched_tokens"), F.col("total_tokens")))


def _percent(shared: Column, total: Column) -> Column:
    return F.try_divide(shared * F.lit(100.0), total.cast("double"))


def _best(scores: Column) -> Column:
    """Of an array of (pct, id_domaine) the highest, the lowest domain among equals; null if there is none."""
    top = lambda a, b: F.when((b["pct"] > a["pct"]) | ((b["pct"] == a["pct"]) & (b["id_domaine"] < a["id_domaine"])), b).otherwise(a)
    return F.when(F.size(scores) > 0, F.aggregate(scores, F.get(scores, F.lit(0)), top))


def domain_match(
    offers: DataFrame, domains: DataFrame, stopwords: DataFrame, weights: tuple[float, float] = (0.6, 0.4),
    mode: str = "faithful",
) -> DataFrame:
    """(id_domaine, nom_domaine, sector, id_local) for the offers; ``offers`` has one row per local id.

    ``per_domain`` scores a domain with both of its own percentages and keeps the best domain of
    each offer. ``faithful`` keeps the source's three cases and their side effects:

    * combined: the best sector domain with the best description percentage. The source pairs every
      sector domain with every description domain of an offer; the best pair is the two best sides.
    * all rows without a sector side compete for one place, whose ids are null.
    * description only: one offer per distinct description, if it has no sector match.
    * sector only: as above for sectors, but empty as soon as any offer has no sector match, because
      the excluded ids then hold a null.

    Ties fall to the lowest offer id, then the lowest domain id. Both texts are scored inside the row, so what is
    shuffled later is one row per offer at most.
    """
    named = domains.select("id_domaine", "nom_domaine")
    names = cut(_domain_tokens(domains, stopwords))
    find = _finder(names, stopwords)
    scored = offers.select("id_local", "sector", "description", find(F.col("sector")).alias("_s"), find(F.col("description")).alias("_d"))

    def scores(side: str) -> Column:
        return F.transform(F.col(f"{side}.found"), lambda m: F.struct(
            _percent(m["unique_matched_tokens"], F.col(f"{side}.total")).alias("pct"), m["id_domaine"].alias("id_domaine")))

    scored = scored.withColumns({"_sp": scores("_s"), "_dp": scores("_d")})
    if mode == "per_domain":
        share = lambda side, i: F.coalesce(F.get(F.transform(F.filter(side, lambda m: m["id_domaine"] == i), lambda m: m["pct"]), F.lit(0)), F.lit(0.0))
        ids = F.array_union(F.transform("_sp", lambda m: m["id_domaine"]), F.transform("_dp", lambda m: m["id_domaine"]))
        both = F.transform(ids, lambda i: F.struct((share("_sp", i) * weights[0] + share("_dp", i) * weights[1]).alias("pct"), i.alias("id_domaine")))
        rows = scored.select("id_local", "sector", both.alias("_b")).select("id_local", "sector", _best(F.col("_b")).alias("_b"))
        best = rows.filter("id_local is not null and _b is not null").select("id_local", "sector", F.col("_b.id_domaine").alias("id_domaine"))
        return best.join(named, "id_domaine").select("id_domaine", "nom_domaine", "sector", "id_local")

    tokens = lambda side: F.array_distinct(F.flatten(F.transform(F.col(f"{side}.found"), lambda m: m["tokens"])))
    # one row per offer, read several times below
    rows = cut(scored.select(
        "id_local", "sector", F.sha2("sector", 256).alias("_st"), F.sha2("description", 256).alias("_dt"),
        _best(F.col("_sp")).alias("s"), _best(F.col("_dp")).alias("d"), tokens("_s").alias("_su"), tokens("_d").alias("_du")))
    offered = rows.filter("id_local is not null")
    best_sector = offered.filter("s is not null")
    with_sector = best_sector.select(F.col("s.id_domaine").alias("id_domaine"), "sector", "id_local")

    # the one place shared by everything without a sector side: a description match beats an unmatched domain
    def unused(side: str) -> DataFrame:
        return names.join(rows.select(F.explode(side).alias("token")).distinct(), "token", "left_anti")

    desc_only = offered.filter("d is not null and s is null").select(F.lit(0).alias("_class"), F.lit(None).cast("bigint").alias("id_domaine"))
    unmatched = unused("_su").select(F.lit(1).alias("_class"), F.col("id_domaine").cast("bigint"))
    nameless = unused("_du").select(F.lit(2).alias("_class"), F.lit(None).cast("bigint").alias("id_domaine"))
    lone = desc_only.unionByName(unmatched).unionByName(nameless).agg(F.min(F.struct("_class", "id_domaine")).alias("_w")).filter("_w is not null")
    combined = with_sector.unionByName(
        lone.select(F.col("_w.id_domaine").alias("id_domaine"), F.lit(None).cast("string").alias("sector"),
                    F.lit(None).cast("string").alias("id_local")))

    def best_per_text(side: str, text: str) -> DataFrame:
        keyed = offered.filter(F.col(side).isNotNull())
        one = dedup_rank(keyed, [text], [F.col(f"{side}.pct").desc(), F.col("id_local").asc()])
        return one.select(F.col(f"{side}.id_domaine").alias("id_domaine"), "sector", "id_local", "s")

    description_only = best_per_text("d", "_dt").filter("s is null").drop("s").withColumn("sector", F.lit(None).cast("string"))
    # the ids of combined rows with a description, null for the rows without a sector side
    described = offered.filter("d is not null").select(F.when(F.col("s").isNotNull(), F.col("id_local")).alias("_sid"))
    sector_only = not_in(best_per_text("s", "_st").drop("s"), "id_local", described, "_sid")
    cases = combined.unionByName(description_only).unionByName(sector_only)
    return cases.join(named, "id_domaine", "left").select("id_domaine", "nom_domaine", "sector", "id_local")
