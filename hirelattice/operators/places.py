"""Place matching: by distance, by names inside the location text, by department code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hirelattice.functions.geo import haversine_km
from hirelattice.operators.dedup import dedup_rank
from hirelattice.session import cut, join_hot

# name levels in rank order; the department code comes second, between the two first
NAME_LEVELS = {"name": "ville", "dept": "departement", "region": "region", "country": "pays"}
FLAG_ORDER = ("name", "code", "dept", "region", "country")

KM_PER_DEGREE = 111.19
MIN_COS = 0.05


def department_code(location: Column) -> Column:
    """The first two digits in a row anywhere in the text."""
    return F.nullif(F.regexp_extract(location, "([0-9]{2})", 1), F.lit(""))


def _place_columns(places: DataFrame, pad_postal: bool) -> DataFrame:
    code = F.col("code_postal").cast("string")
    code = F.lpad(code, 5, "0") if pad_postal else code
    return places.select(
        F.col("id_lieu").cast("bigint").alias("id_lieu"),
        *[F.lower(c).alias(f"p_{level}") for level, c in NAME_LEVELS.items()],
        F.substring(code, 1, 2).alias("p_code"),
        F.col("latitude").try_cast("double").alias("p_lat"), F.col("longitude").try_cast("double").alias("p_lon"),
        F.col("population").alias("p_pop"))


def _flags() -> dict[str, Column]:
    """0/1 per way a place is named by the location text; null on either side is 0."""
    hits = {level: F.contains(F.col("loc"), F.col(f"p_{level}")) for level in NAME_LEVELS}
    hits["code"] = department_code(F.col("loc")) == F.col("p_code")
    return {f: F.coalesce(hits[f], F.lit(False)).cast("int") for f in FLAG_ORDER}


def _rank() -> Column:
    """Smaller is better: flags in order, then the larger population (null last), then the lower id."""
    flags = _flags()
    return F.struct(*[(-flags[f]).alias(f) for f in FLAG_ORDER],
                    F.coalesce(-F.col("p_pop"), F.lit(1)).cast("bigint").alias("pop"), F.col("id_lieu"))


def _keyed(places: DataFrame) -> DataFrame:
    """Every place under each of its keys: (level, key, place columns)."""
    keys = F.array(*[F.struct(F.lit(f).alias("level"), F.col(f"p_{f}").alias("key")) for f in FLAG_ORDER])
    return places.withColumn("_k", F.explode(keys)).select("*", "_k.level", "_k.key").drop("_k").filter("key is not null")


def _text_hits(locations: DataFrame, keyed: DataFrame) -> DataFrame:
    """(loc, level, key) for every place key found in a distinct location text.

    Containment becomes equality: each short text is cut into its substrings of the lengths that
    occur among the keys. Country and region keys stay keys here; their places are not unnested.
    """
    names = keyed.filter("level <> 'code'").select("level", "key").distinct()
    lengths = [r[0] for r in names.select(F.length("key")).distinct().collect()]
    loc = F.col("loc")

    def substrings(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(loc) - n + 1)
        return F.when(F.length(loc) >= n, F.transform(starts, lambda i: F.substring(loc, i, F.lit(n)))).otherwise(
            F.array().cast("array<string>"))

    pieces = [substrings(n) for n in lengths]
    cut = locations.select("loc", F.explode(F.array_distinct(F.concat(*pieces)) if pieces else F.array().cast("array<string>")).alias("key"))
    by_name = cut.join(names, "key").select("loc", "level", "key")
    codes = keyed.filter("level = 'code'").select("level", "key").distinct()
    by_code = locations.withColumn("key", department_code(loc)).join(codes, "key").select("loc", "level", "key")
    return by_name.unionByName(by_code)


def _best_by_text(hits: DataFrame, keyed: DataFrame) -> DataFrame:
    """(loc, id) of the best place when no distance counts.

    Places under one key that agree on all lower levels differ only by population, so each such
    group is stood for by its best place. The best place overall is one of these, at its highest level.
    """
    reps = []
    for i, level in enumerate(FLAG_ORDER):
        same = [f"p_{f}" for f in FLAG_ORDER[i:]]
        order = [F.col("p_pop").desc_nulls_last(), F.col("id_lieu").asc()]
        reps.append(dedup_rank(keyed.filter(F.col("level") == level), ["level", "key", *same], order))
    candidates = hits.join(reduce(DataFrame.unionByName, reps), ["level", "key"])
    return candidates.groupBy("loc").agg(F.min(_rank()).alias("_r")).select("loc", F.col("_r.id_lieu").alias("text_id"))


def _lon_width(row: Column, step: float) -> Column:
    """Width in degrees of the cells in a latitude row, at least ``step`` wide on the ground in the row and beside it."""
    reach = F.greatest(F.abs(row - 1), F.abs(row + 2)) * step
    cosine = F.cos(F.radians(F.least(reach, F.lit(90.0))))
    # close to the poles one cell spans all longitudes
    return F.when(cosine < MIN_COS, F.lit(1440.0)).otherwise(F.lit(step) / cosine)


def _nearby(points: DataFrame, places: DataFrame, radius_km: float) -> DataFrame:
    """(loc, lat, lon, place) closer than the radius, through a grid join on neighbouring cells."""
    step = 1.1 * radius_km / KM_PER_DEGREE
    lat_row = lambda c: F.floor(F.col(c) / step)
    there = places.filter("p_lat is not null and p_lon is not null")
    # copies across the date line
    shifts = F.array(F.lit(0.0), F.when(F.col("p_lon") > 170, F.lit(-360.0)), F.when(F.col("p_lon") < -170, F.lit(360.0)))
    there = there.withColumn("_s", F.explode(F.array_compact(shifts))).withColumn("_row", lat_row("p_lat"))
    there = there.withColumn("_col", F.floor((F.col("p_lon") + F.col("_s")) / _lon_width(F.col("_row"), step))).drop("_s")
    here = points.withColumn("_row", F.explode(F.array(*[lat_row("lat") + d for d in (-1, 0, 1)])))
    cell = F.floor(F.col("lon") / _lon_width(F.col("_row"), step))
    here = here.withColumn("_col", F.explode(F.array(*[cell + d for d in (-1, 0, 1)])))
    near = here.join(there, ["_row", "_col"]).drop("_row", "_col")
    near = near.withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon")))
    return near.filter(F.col("km") < radius_km)


def _nearest(pairs: DataFrame, name: str) -> DataFrame:
    best = F.min(F.struct(F.col("km"), _rank().alias("rank")))
    return pairs.groupBy("loc", "lat", "lon").agg(best.alias("_b")).select(
        "loc", "lat", "lon", F.col("_b.rank.id_lieu").alias(name))


def _nearest_named(points: DataFrame, hits: DataFrame, keyed: DataFrame) -> DataFrame:
    """Nearest place among those the location text names, for points with no place in the radius.

    A named country holds a large part of all places, so its places are first summed up by one-degree
    cell. The distance to a cell's middle, plus and minus the cell's own extent, bounds the distance to
    its places; only cells that can hold the nearest place are opened.
    """
    located = keyed.filter("p_lat is not null and p_lon is not null").withColumns(
        {"_cy": F.floor("p_lat"), "_cx": F.floor("p_lon")})
    my, mx = F.col("_cy") + 0.5, F.col("_cx") + 0.5
    cells = located.groupBy("level", "key", "_cy", "_cx").agg(
        F.max(haversine_km(F.col("p_lat"), F.col("p_lon"), F.col("_cy") + 0.5, F.col("_cx") + 0.5)).alias("_extent"))
    probes = points.join(hits, "loc").join(cells, ["level", "key"])
    middle = haversine_km(F.col("lat"), F.col("lon"), my, mx)
    probes = probes.withColumns({"_lo": middle - F.col("_extent"), "_hi": middle + F.col("_extent")})
    bound = F.min("_hi").over(Window.partitionBy("loc", "lat", "lon"))
    opened = probes.withColumn("_bound", bound).filter(F.col("_lo") <= F.col("_bound") + 1e-6)
    pairs = opened.select("loc", "lat", "lon", "level", "key", "_cy", "_cx").join(located, ["level", "key", "_cy", "_cx"])
    return _nearest(pairs.withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"))), "named_id")


def place_match(offers: DataFrame, places: DataFrame, radius_km: float = 10.0, pad_postal: bool = False) -> DataFrame:
    """Add the best place's id to each offer; null when nothing matches.

    A place matches within the radius, by department code, or when its city, department, region or
    country name stands anywhere in the location text (ignoring case). Rank: within the radius,
    nearer, city, code, department, region, country, larger population, lower id; unknown distances
    and populations come last. The source's postal code has lost its leading zero, so ``1000`` gives
    department ``10``; ``pad_postal`` gives ``01``.

    No offer is compared with all places: the work is done once per distinct text and per distinct
    text and point, by equality of grid cells and of name keys.
    """
    marked = offers.withColumns({
        "loc": F.lower("location_name"), "lat": F.col("latitude").try_cast("double"),
        "lon": F.col("longitude").try_cast("double")})
    dims = _place_columns(places, pad_postal)
    keyed = _keyed(dims)
    locations = marked.select("loc").filter("loc is not null").distinct()
    points = marked.select("loc", "lat", "lon").filter("lat is not null and lon is not null").distinct()

    # the hits are read by both later branches, the near places by the test for what is left
    hits = cut(_text_hits(locations, keyed))
    by_text = _best_by_text(hits, keyed)
    near = cut(_nearest(_nearby(points, dims, radius_km), "near_id"))
    same_point = lambda a, b: (
        a["loc"].eqNullSafe(b["loc"]) & (a["lat"] == b["lat"]) & (a["lon"] == b["lon"]))
    open_points = points.join(near, same_point(points, near), "left_anti")
    named = _nearest_named(open_points, hits, keyed)
    found = near.withColumnRenamed("near_id", "_id").unionByName(named.withColumnRenamed("named_id", "_id"))
    found = found.select(F.col("loc").alias("f_loc"), F.col("lat").alias("f_lat"), F.col("lon").alias("f_lon"), F.col("_id").alias("point_id"))
    by_point = marked.join(found, F.col("loc").eqNullSafe(F.col("f_loc")) & (F.col("lat") == F.col("f_lat")) & (F.col("lon") == F.col("f_lon")), "left")
    return (
        join_hot(by_point, by_text, "loc", "left")
        .withColumn("id_lieu", F.coalesce("point_id", "text_id"))
        .drop("loc", "lat", "lon", "f_loc", "f_lat", "f_lon", "point_id", "text_id")
    )
