"""URL rules by a Bloom filter cascade: native DataFrame operations only.

The keys that any url of the corpus could match (its host's suffixes with its path's beginnings, in the
lengths that occur among the rules) are the key universe. Level 1 encodes the listed keys, level 2 the
keys of the universe that level 1 takes for listed wrongly, level 3 the listed keys that level 2 takes
for such, and so on until a level errs no more. A key is listed exactly if the first level that does not
hold it is an even one, so for every key of the universe the answer is exact, and urls are never joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hirelattice.llm.common import stored

HASHES = 4
# a level is sent to every task, so its size is checked: bits of the largest one
MOST_BITS = 1 << 28


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; then up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidates(host: str, path: str, lengths: list[int]) -> Column:
    """All (host suffix, path beginning) keys of a url, longest first: the order in which rules win.

    Longer means more characters of host and path together, then the longer host.
    """
    labels = f"split({host}, '[.]')"
    suffixes = f"transform(sequence(1, size({labels})), i -> array_join(slice({labels}, i, size({labels})), '.'))"
    starts = f"filter(array({', '.join(f'{n}' for n in sorted(lengths, reverse=True))}), n -> n <= length({path}))"
    pairs = f"flatten(transform({suffixes}, s -> transform({starts}, n -> struct(-(length(s) + n) as l, -length(s) as h, concat(s, substr({path}, 1, n)) as k))))"
    return F.expr(f"transform(array_sort({pairs}), x -> x.k)")


def _slots(key: Column, level: int, bits: int) -> list[Column]:
    one, two = (F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(bits)) for salt in (level, -1 - level))
    return [F.pmod(one + two * F.lit(i), F.lit(bits)) for i in range(HASHES)]


def _bitmap(keys: DataFrame, level: int, bits: int) -> bytes:
    """The filter of one level; only its bytes reach the driver, 4096 for each bucket in use."""
    slots = keys.select(F.explode(F.array(*_slots(F.col("key"), level, bits))).alias("slot"))
    parts = slots.groupBy((F.col("slot") / F.lit(32768)).cast("long").alias("bucket")).agg(
        F.bitmap_construct_agg((F.col("slot") % 32768).cast("long")).alias("bits"))
    out = bytearray(bits // 8)
    for row in parts.collect():
        out[row["bucket"] * 4096:(row["bucket"] + 1) * 4096] = row["bits"]
    return bytes(out)


class Cascade:
    """Levels of a Bloom filter cascade over a known universe of keys."""

    def __init__(self, levels: list[bytes]):
        self.levels = levels

    @classmethod
    def build(cls, universe: DataFrame, listed: DataFrame, bits_per_key: int = 12) -> "Cascade":
        """``universe(key)`` and ``listed(key)``, each distinct; listed keys outside the universe do no harm."""
        inside, outside = stored(listed.select("key"), "listed"), None
        others = universe.join(inside, "key", "left_anti")
        levels: list[bytes] = []
        while True:
            n = inside.count()
            if not n:
                return cls(levels)
            bits = max(32768, 1 << (n * bits_per_key - 1).bit_length())
            if bits > MOST_BITS:
                raise ValueError(f"a level of {n} keys needs {bits} bits; split the list by a hash of the key and build a cascade for each part")
            levels.append(_bitmap(inside, len(levels), bits))
            wrong = stored(others.where(cls._held(F.col("key"), len(levels) - 1, levels[-1])), "level")
            inside, others = wrong, inside

    @staticmethod
    def _held(key: Column, level: int, data: bytes) -> Column:
        """Whether all slots of the key are set: a byte of the literal, then its bit."""
        bits = F.lit(data)

        def set_at(slot: Column) -> Column:
            byte = F.ascii(F.decode(F.substring(bits, (slot / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
            return F.getbit(byte, (slot % 8).cast("int")) == 1

        return reduce(lambda a, b: a & b, [set_at(s) for s in _slots(key, level, len(data) * 8)])

    def holds(self, key: Column) -> Column:
        """Exact for every key of the universe."""
        result = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels) - 1, -1, -1):
            result = F.when(self._held(key, level, self.levels[level]), result).otherwise(F.lit(level % 2 == 1))
        return result


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """Add ``host, path, rule, verdict`` to ``pages(url, ...)`` by ``rules(key, verdict)``.

    The longest listed candidate is the url's rule. Two cascades are built, of all listed keys and of
    those that block. A url without a rule is on no list and gets ``otherwise``. Null urls and urls
    without ``://`` have empty host and path and match nothing unless an empty key is listed.
    """
    host, path = split_url(F.col("url"))
    urls = pages.withColumns({"host": host, "path": path})
    listed = rules.where("key is not null").groupBy("key").agg(F.max("verdict").alias("verdict"))
    lengths = [r[0] for r in listed.select(F.expr("length(key) - length(substring_index(key, '/', 1))").alias("n")).distinct().collect()]
    if not lengths:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(otherwise)})
    keys = candidates("host", "path", lengths)
    seen = urls.select("host", F.substring("path", 1, max(lengths)).alias("path")).distinct()
    universe = stored(seen.select(F.explode(keys).alias("key")).distinct(), "universe")
    on_list = Cascade.build(universe, listed.select("key"))
    blocks = Cascade.build(universe, listed.where("verdict = 'block'").select("key"))
    found = urls.withColumn("rule", F.get(F.filter(keys, on_list.holds), 0))
    verdict = F.when(F.col("rule").isNull(), F.lit(otherwise)).when(blocks.holds(F.col("rule")), "block").otherwise("allow")
    return found.withColumn("verdict", verdict)
