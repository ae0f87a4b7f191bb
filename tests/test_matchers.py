import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hirelattice.functions.calendar import calendar
from hirelattice.operators import domains as domains_module
from hirelattice.operators import rule_data as rd
from hirelattice.operators import star
from hirelattice.operators.companies import company_match
from hirelattice.operators.dates import date_match
from hirelattice.operators.dictionary import dictionary_match
from hirelattice.operators.domains import domain_match, scored_matches
from hirelattice.operators.numbering import number_rows
from hirelattice.operators.places import place_match
from hirelattice.operators.rules import rule_match, rule_match_by_join
from hirelattice.operators.tokens import not_in
from hirelattice.plans.bindings import CONTRACTS, REMOTE_MODES, SENIORITIES
from hirelattice.queries import joins
from hirelattice.session import join_hot, run_dir

SETS = [(CONTRACTS, rd.CONTRACT_RULES, "type_contrat", "id_contrat"),
        (SENIORITIES, rd.SENIORITY_RULES, "type_seniorite", "id_seniorite"),
        (REMOTE_MODES, rd.REMOTE_RULES, "type_teletravail", "id_teletravail")]
FIELDS = ["description", "contract_type", "contract_duration", "experience_required"]


def _offers(spark, data):
    full = [(i, f"L{i}", *[row.get(f) for f in FIELDS]) for i, row in enumerate(data)]
    return spark.createDataFrame(full, "id_offre long, id_local string, " + ", ".join(f"{f} string" for f in FIELDS))


@pytest.mark.parametrize("labels,rules,label,id_column", SETS)
def test_every_keyword_finds_a_label(spark, labels, rules, label, id_column):
    data = [{field: f"xx {word.upper()} yy"} for r in rules.rules for field, words in r.keywords.items() for word in words]
    out = rule_match(_offers(spark, data), labels, rules, id_column)
    assert out.filter(F.col(id_column).isNull()).count() == 0


@pytest.mark.parametrize("labels,rules,label,id_column", SETS)
def test_projection_equals_join(spark, labels, rules, label, id_column):
    rng = random.Random(5)
    words = [w for r in rules.rules for ws in r.keywords.values() for w in ws] + [x for _, x in labels] + ["rien", "autre"]
    data = [{f: (" ".join(rng.sample(words, rng.randint(0, 3))) if rng.random() > 0.2 else None) for f in FIELDS} for _ in range(150)]
    offers = _offers(spark, data)
    dim = spark.createDataFrame(labels, f"{id_column} long, {label} string")
    a = rule_match(offers, labels, rules, id_column).select("id_offre", id_column)
    b = rule_match_by_join(offers, dim, label, rules, id_column).select("id_offre", id_column)
    assert rows(a) == rows(b)


def test_contract_priorities(spark):
    offers = _offers(spark, [
        {"contract_type": "CDD", "description": "stage en alternance"},
        {"description": "alternance et stage"},
        {"description": "mission permanente, embauche"},
        {},
    ])
    got = rows(rule_match(offers, CONTRACTS, rd.CONTRACT_RULES, "id_contrat").select("id_offre", "id_contrat"))
    # exact beats all; two partial matches fall to the better rule; a keyword only; nothing
    assert got == [(0, 2), (1, 6), (2, 1), (3, None)]


def test_dictionary_edges(spark):
    offers = spark.createDataFrame([
        (1, "java start"), (2, "uses java here"), (3, "ends java"), (4, "uses java, here"), (5, "a big  data b"),
        (6, "x machine learning y"), (7, None)], "id_local long, d string")
    labels = spark.createDataFrame([(1, "Java"), (2, "big  data"), (3, "machine learning"), (4, "b%g")], "id long, skill string")
    got = rows(dictionary_match(offers, labels, "skill", ["d"], ["id_local"]).select("id_local", "id"))
    assert got == [(2, 1), (5, 2), (6, 3)]
    wild = rows(dictionary_match(offers, labels, "skill", ["d"], ["id_local"], wildcards=True).select("id_local", "id"))
    assert wild == [(2, 1), (5, 2), (5, 4), (6, 3)]


PLACE = "id_lieu long, code_postal long, ville string, departement string, region string, pays string, latitude double, longitude double, population long"


def test_place_rules(spark):
    places = spark.createDataFrame([
        (1, 75001, "Paris", "Seine", "IDF", "France", 48.86, 2.35, 2000000),
        (2, 1000, "Bourg", "Ain", "ARA", "France", 46.2, 5.22, 40000),
        (3, 33000, "Bordeaux", "Gironde", "NAQ", "France", 44.84, -0.58, 250000),
        (4, 75002, "Paris", "Seine", "IDF", "France", None, None, None)], PLACE)
    offers = spark.createDataFrame([
        (1, "Bordeaux", "48.90", "2.35"),       # 4.4 km from Paris: distance beats the name
        (2, "Bordeaux", None, None),
        (3, "75 - Paris", None, None),          # the larger population
        (4, "10 - Bourgade", None, None),       # postal code 1000 has lost its zero
        (5, "France", None, None),              # the most populated place
        (6, "France", "44.0", "-0.5"),          # the nearest place of the country
        (7, "Mars", None, None), (8, None, None, None), (9, None, "44.84", "-0.58"), (10, "Mars", "0", "0"),
        (11, "x", "44.84", "-0.707")            # 10.02 km
    ], "id_offre long, location_name string, latitude string, longitude string").withColumn("id_local", F.col("id_offre").cast("string"))
    got = dict(rows(place_match(offers, places).select("id_offre", "id_lieu")))
    assert got == {1: 1, 2: 3, 3: 1, 4: 2, 5: 1, 6: 3, 7: None, 8: None, 9: 3, 10: None, 11: None}
    padded = dict(rows(place_match(offers.filter("id_offre = 4"), places.withColumn("ville", F.lit("zz")), pad_postal=True).select("id_offre", "id_lieu")))
    assert padded == {4: None}


def test_place_match_equals_brute_force(spark):
    import math

    rng = random.Random(3)
    names = ["ab", "abc", "bc", "xyz", "yz"]
    places = [(i, rng.choice([1000, 75000, 33000]), rng.choice(names), rng.choice(names), rng.choice(names[:2]), "fr",
               *([None, None] if rng.random() < .2 else [rng.uniform(-80, 89.9), rng.choice([-179.99, 179.99, rng.uniform(-180, 180)])]),
               rng.choice([None, 5, 9])) for i in range(60)]
    # offers close to places, also over the date line and near the poles
    offers = []
    for i in range(200):
        p = rng.choice(places)
        loc = rng.choice(["abc 75", "xyz", "nothing", "in fr", None, "33 bc"])
        if p[6] is None or rng.random() < .3:
            offers.append((i, str(i), loc, None, None))
        else:
            lon = p[7] + rng.uniform(-.1, .1)
            offers.append((i, str(i), loc, p[6] + rng.uniform(-.06, .06), (lon + 180) % 360 - 180))

    def km(a, b):
        if None in a or None in b:
            return None
        la, lo, lb, lp = map(math.radians, (a[0], a[1], b[0], b[1]))
        x = math.sin((la - lb) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lo - lp) / 2) ** 2
        return 12742 * math.asin(math.sqrt(min(1, x)))

    def best(o):
        found = []
        loc = o[2]
        digits = __import__("re").search(r"\d{2}", loc or "")
        for p in places:
            d = km(o[3:], p[6:8])
            flags = [loc is not None and p[2] in loc, bool(digits) and str(p[1])[:2] == digits.group(), *[loc is not None and p[j] in loc for j in (3, 4, 5)]]
            near = d is not None and d < 10
            if near or any(flags):
                found.append((not near, d is None, d or 0, *[not f for f in flags], p[8] is None, -(p[8] or 0), p[0]))
        return min(found)[-1] if found else None

    got = dict(rows(place_match(
        spark.createDataFrame(offers, "id_offre long, id_local string, location_name string, latitude double, longitude double"),
        spark.createDataFrame(places, PLACE)).select("id_offre", "id_lieu")))
    assert got == {o[0]: best(o) for o in offers}


def test_company_priorities(spark):
    companies = spark.createDataFrame([
        (1, "Acme France", "PME"), (2, "Acme Groupe", "GE"), (3, "ACME", None), (4, " Other", "GE"), (5, None, "GE")],
        "siren long, nom_entreprise string, categorie_entreprise string")
    offers = spark.createDataFrame([(1, "acme"), (2, "Acme Lyon"), (3, "  other x"), (4, None), (5, "none")], "id_offre long, company_name string")
    got = rows(company_match(offers, companies).select("id_offre", "id_entreprise"))
    assert got == [(1, 3), (2, 2), (3, 4), (4, None), (5, None)]


def test_company_match_splits_a_hot_word(spark):
    """Nine tenths of the offers share a word; the plan as run has skewed joins, and the result stays right."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in keys}
    companies = spark.range(300).selectExpr("id as siren", "concat('w', id, ' sa') as nom_entreprise", "'PME' as categorie_entreprise")
    path = run_dir(spark, "hot-offers")
    # many files, so that the hot word comes from many map tasks
    spark.range(0, 200_000, 1, 16).selectExpr("id as id_offre", "concat('w', if(id % 10 < 9, 1, id % 400), ' ', uuid()) as company_name").write.parquet(path)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        out = company_match(spark.read.parquet(path), companies)
        got = {r[0]: r[1] for r in out.groupBy("id_entreprise").count().collect()}
        done = out.groupBy("id_entreprise").count()
        done.collect()
        plan = done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum(got.values()) == 200_000 and got[1] >= 180_000
    assert "skew=true" in plan


def test_join_hot_splits_a_value_against_an_aggregate(spark):
    """Nine tenths of the rows share a key and the other side comes from an aggregate; no row is lost, and Spark splits the key."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in keys}
    path = run_dir(spark, "hot-terms")
    spark.range(0, 200_000, 1, 16).selectExpr("id", "concat('w', if(id % 10 < 9, 1, id % 400)) as term", "uuid() as rest").write.parquet(path)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        large = spark.read.parquet(path)
        out = join_hot(large, large.groupBy("term").agg(F.count("*").alias("df")), "term", "left").groupBy("term").agg(F.count("*").alias("n"), F.max("df").alias("df"))
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum(r["n"] for r in got) == 200_000 and all(r["n"] == r["df"] for r in got)
    assert "skew=true" in plan


def test_dates_default(spark):
    offers = spark.createDataFrame([(1, "a", "2024-01-02 10:00:00", None), (2, "a", "2024-01-03 10:00:00", "2024-01-04 00:00:00"), (3, "b", "1980-01-01 00:00:00", None)],
                                   "id_offre long, id_local string, date_created string, date_updated string").withColumns(
        {c: F.col(c).cast("timestamp") for c in ("date_created", "date_updated")})
    got = rows(date_match(offers, calendar(spark, "2024-01-01", "2024-12-31")).select(
        "id_local", F.col("id_date_created").cast("string"), F.col("id_date_updated").cast("string")))
    assert got == [("a", "2024-01-03", "2024-01-04"), ("b", "1900-01-01", "1900-01-01")]


def test_not_in_rules(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert rows(not_in(a, "x", spark.createDataFrame([(1,)], "y int"), "y")) == [(2,)]
    assert rows(not_in(a, "x", spark.createDataFrame([(1,), (None,)], "y int"), "y")) == []
    assert rows(not_in(a, "x", spark.createDataFrame([], "y int"), "y")) == [(1,), (2,), (None,)]


def test_domains_traps(spark):
    offers = spark.createDataFrame([
        ("a", "banque assurance", "gestion banque"), ("b", "banque assurance", "autre chose"), ("c", None, "gestion projet"), ("d", "banque seule", None)],
        "id_local string, sector string, description string")
    domains = spark.createDataFrame([(1, "Banque, assurance"), (2, "Gestion projet"), (3, "Zebre")], "id_domaine int, nom_domaine string")
    stop = spark.createDataFrame([("seule",)], "word string")
    got = rows(domain_match(offers, domains, stop).select("id_domaine", "id_local"))
    # c has no sector: it takes the shared null row, and is described by domain 2; d keeps its sector
    assert got == [(1, "a"), (1, "b"), (1, "d"), (2, "c"), (None, None)]
    per = rows(domain_match(offers, domains, stop, mode="per_domain").select("id_domaine", "id_local"))
    assert per == [(1, "a"), (1, "b"), (1, "d"), (2, "c")]


@pytest.mark.parametrize("table", [100_000, 2])
def test_token_matches_in_the_row(spark, table, monkeypatch):
    """Counts, lists and shares against plain Python, with one lookup table and with several."""
    monkeypatch.setattr(domains_module, "NAMES", table)
    names = [(1, "Gestion de projet, gestion"), (2, "banque"), (3, "Zebre banque"), (4, ""), (5, None), (None, "projet")]
    texts = [("a", "projet PROJET gestion, seule"), ("b", None), ("c", ""), ("d", "rien de tel"), ("e", "banque banque gestion zzz yy"), (None, "banque")]
    offers = spark.createDataFrame(texts, "id_local string, description string")
    domains = spark.createDataFrame(names, "id_domaine int, nom_domaine string")
    stop = spark.createDataFrame([("seule",), (None,)], "word string")

    def pieces(text):
        return [w for w in re.sub("[-',.\"]+", " ", (text or "").lower()).split(" ") if len(w) > 2 and w != "seule"]

    want = set()
    for i, name in names:
        for o, text in texts:
            shared = set(pieces(name)) & set(pieces(text))
            if shared and i is not None:
                n = sum(pieces(name).count(w) * pieces(text).count(w) for w in shared)
                want.add((i, o, n, len(shared), " ".join(sorted(shared)), round(100 * len(shared) / len(set(pieces(text))), 6)))
    got = scored_matches(domains, offers, "description", stop)
    got = [tuple(r) for r in got.selectExpr("id_domaine", "id_local", "matched_tokens", "unique_matched_tokens", "matching_tokens", "round(pct, 6)").collect()]
    assert (3, None, 1, 0, None, None) in got
    assert set(got) == want | {(3, None, 1, 0, None, None)}
    assert len(got) == len(want) + 1


def test_wide_table_rewrite_equals_naive(spark, tables):
    a, b = joins._wide(tables), joins._wide(tables, naive=True)
    assert rows(a.select(*sorted(a.columns))) == rows(b.select(*sorted(a.columns)))


def test_numbering_is_consecutive_with_a_hot_value(spark):
    df = spark.range(5000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    got = number_rows(df, ["k", "id"]).orderBy("row_id").collect()
    assert [r["row_id"] for r in got] == list(range(1, 5001))
    assert [(r["k"], r["id"]) for r in got] == sorted((r["k"], r["id"]) for r in got)


def test_string_aggregate_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (2, "a"), (2, "b")], "id int, x string")
    assert rows(star.join_values(df, ["id"], {"s": ("x", ", ")})) == [(1, None), (2, "a, b")]
