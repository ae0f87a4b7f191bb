"""Sharding by sampled splitters: native DataFrame operations only.

The sort key of a row is (hash of its text, id, row mark), so equal texts lie side by side and go to one
shard unless a shard's bound falls among them. A sample of keys, each drawn with a chance in proportion
to its row's size, gives quantile bounds of many narrow ranges; ranges that come out overfull are cut
again by a sample of their own. Then each range is small, its rows are ranked inside it, and the exact
number of bytes before a row decides its shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hirelattice.llm.common import stored, total

# bytes that a row counts besides its text
OVERHEAD = 16
# how much fuller than the mean a range may be before it is cut again
OVERFULL = 2.0
# sampled keys for each range
DRAWS = 24


def _drawn(size: Column, rate: float, salt: int) -> Column:
    """True with a chance of size * rate; decided by a hash of the key, so a retried task draws the same."""
    u = F.pmod(F.xxhash64("h", "id", "mark", F.lit(salt)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return u < size * F.lit(rate)


def _bounds(keys: list, parts: int) -> list:
    keys = sorted(keys)
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def _range_of(bounds: list) -> Column:
    """How many bounds are at or below the row's key: first among every 32nd bound, then among 32 of them."""
    if not bounds:
        return F.lit(0)
    step = 32
    key = F.struct("h", "id", "mark")
    literal = lambda rows: F.expr("array(" + ", ".join(f"named_struct('h', {h}L, 'id', {i}L, 'mark', {m}L)" for h, i, m in rows) + ")")
    below = lambda array: F.size(F.filter(array, lambda b: b <= key))
    coarse = below(literal(bounds[::step]))
    blocks = F.array(*[literal(bounds[i:i + step]) for i in range(0, len(bounds), step)])
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + below(F.get(blocks, coarse - 1)))


def shard_rows(rows: DataFrame, shards: int, ranges: int | None = None) -> DataFrame:
    """Add ``shard`` and ``slot`` to stored ``rows(id, size, h, ...)`` so that shards hold nearly equal bytes.

    Sizes of two shards differ by less than two rows' sizes. ``slot`` counts the rows of a shard from 0
    without gaps. Null ids come first within a text; wholly repeated rows are told apart by ``mark``,
    so any number of copies can be split. An empty table gives an empty table.
    """
    ranges = ranges or 24 * shards
    rows = rows.withColumn("id", F.coalesce("id", F.lit(-(1 << 63))))
    whole, n = total(rows, F.sum("size"), F.count("*"))
    if not n:
        return rows.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    draw = lambda df, rate, salt: [tuple(r) for r in df.where(_drawn(F.col("size"), rate, salt)).select("h", "id", "mark").collect()]
    bounds = _bounds(draw(rows, DRAWS * ranges / whole, 1), ranges)
    for again in range(2, 5):
        placed = rows.withColumn("range", _range_of(bounds))
        held = {r["range"]: r["bytes"] for r in placed.groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
        over = {k: v for k, v in held.items() if v > OVERFULL * whole / ranges}
        if not over:
            break
        more = draw(placed.where(F.col("range").isin(list(over))), DRAWS * ranges / whole, again)
        edges = [None, *bounds, None]
        for k, v in over.items():
            inside = [x for x in more if (edges[k] is None or x >= edges[k]) and (edges[k + 1] is None or x < edges[k + 1])]
            bounds = sorted({*bounds, *_bounds(inside, max(2, round(v * ranges / whole)))})
    placed = rows.withColumn("range", _range_of(bounds))
    held = sorted(tuple(r) for r in placed.groupBy("range").agg(F.sum("size"), F.count("*")).collect())
    before, seen = {}, (0, 0)
    for k, size, count in held:
        before[k] = seen
        seen = (seen[0] + size, seen[1] + count)
    table = lambda i: F.expr("array(" + ", ".join(f"{before.get(k, (0, 0))[i]}L" for k in range(len(bounds) + 1)) + ")")
    over = "over (partition by range order by h, id, mark rows between unbounded preceding and 1 preceding)"
    ranked = placed.select(
        "*", F.expr(f"coalesce(sum(size) {over}, 0)").alias("ahead"), F.expr(f"count(*) {over}").alias("rank")
    ).select("*", (F.get(table(0), "range") + F.col("ahead")).alias("bytes_before"), (F.get(table(1), "range") + F.col("rank")).alias("place"))
    sharded = stored(ranked.withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"((bytes_before * 2 + size) * {shards}) div {2 * whole}L")).cast("int")), "sharded")
    start = {r["shard"]: r["least"] for r in sharded.groupBy("shard").agg(F.min("place").alias("least")).collect()}
    offset = F.array(*[F.lit(start.get(k, 0)).cast("long") for k in range(shards)])
    return sharded.withColumn("slot", F.col("place") - F.get(offset, "shard"))


def shard_documents(documents: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``documents(doc_id, text)``.

    The law is ``bytes``: sizes near equal. A null text counts as empty; other columns are ignored.
    """
    data = F.coalesce("text", F.lit("")).cast("binary")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("id"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.xxhash64(data).alias("h"), F.monotonically_increasing_id().alias("mark"))
    return shard_rows(stored(rows, "shard-keys"), shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

