"""Two tokenizers' tokens of the same texts, aligned by the bytes where tokens of both end.

Both encode space + text. The ends of a text's tokens are two ascending lists of byte offsets; the shorter one
drives an exponential and then binary search through the longer. The offsets in common cut both lists into groups,
and the differences of their ranks say which tokens a group holds. A link is a pair of tokens of one group.

Texts are cut before a space that follows another character than white space and precedes any: neither
vocabulary has a token that reaches over such a place, so tokens end there in both, and each distinct piece is
encoded and aligned once per task. ``test_alignment`` holds the pieces against whole texts.

How many documents hold an id pair is counted by Spark with map-side combine. The pairs held by most documents,
``HEAVY`` of them at most, go to all tasks as sorted arrays, where nearly all links find their count without a
shuffle; the links of rare pairs are joined. The best count of an id is one row per id of the first vocabulary.

Null and empty texts, and texts whose tokens of either kind don't spell space + text, have no tokens: zeros and an
empty string of groups. Ids of documents are only passed on; null and repeated ones are rows (documents) like any other.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hirelattice.llm.common import stored
from hirelattice.llm.tokens import text_runs

# pairs that every task holds
HEAVY = 1 << 18
# pieces, and characters of them, that a task keeps; beyond either its memory starts anew
KEPT, KEPT_CHARACTERS = 800_000, 16_000_000
# white space that begins with another character than a space, or ends the text after one space, is not cut off
_PIECES = re.compile(r"\s*\S+(?:[^\S\x20]\s*\S+)*(?:[^\S\x20]\s*\Z|\x20\Z)?|\s+")


def galloping(short: np.ndarray, long: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each value of ``short`` its place in ``long[start:stop]``, ascending there, or -1.

    All searches run side by side: steps double until they reach the value, then the last step is halved.
    """
    low, step = start.copy(), np.ones(len(short), np.int64)
    high = np.minimum(low, stop)
    going = (high < stop) & (long[np.minimum(high, len(long) - 1)] < short) if len(long) else np.zeros(len(short), bool)
    while going.any():
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + step[going], stop[going])
        step[going] *= 2
        going[going] = (high[going] < stop[going]) & (long[np.minimum(high[going], len(long) - 1)] < short[going])
    while (open_ := low < high).any():
        mid = (low + high) // 2
        less = open_ & (long[np.minimum(mid, len(long) - 1)] < short)
        low = np.where(less, mid + 1, low)
        high = np.where(open_ & ~less, mid, high)
    found = (low < stop) & (long[np.minimum(low, len(long) - 1)] == short) if len(long) else np.zeros(len(short), bool)
    return np.where(found, low, -1)


def common_ends(a: np.ndarray, a_first: np.ndarray, b: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, i, j) of all ends with ``a[i] == b[j]`` in one text; ``a_first[t]:a_first[t + 1]`` are text t's."""
    n_a, n_b = np.diff(a_first), np.diff(b_first)
    found = []
    for short, s_first, long, l_first, texts in (
            (a, a_first, b, b_first, np.flatnonzero(n_a <= n_b)), (b, b_first, a, a_first, np.flatnonzero(n_a > n_b))):
        sizes = np.diff(s_first)[texts]
        of = np.repeat(texts, sizes)
        edge = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(s_first[texts] - edge[:-1], sizes) + np.arange(edge[-1])
        place = galloping(short[at], long, l_first[of], l_first[of + 1])
        hit = place >= 0
        i, j = at[hit], place[hit]
        found.append((of[hit], i, j) if short is a else (of[hit], j, i))
    text, i, j = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(i, kind="stable")
    return text[order], i[order], j[order]


def byte_level_entries(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary file."""
    # bytes that stand for themselves; the others follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    special = {t["id"]: t["content"].encode() for t in data["added_tokens"]}
    vocabulary = {v: bytes(byte[c] for c in k) for k, v in data["model"]["vocab"].items() if v not in special} | special
    return [vocabulary.get(k, b"") for k in range(max(vocabulary) + 1)]


def piece_entries(model) -> list[bytes]:
    """The bytes of every id of a sentencepiece model with byte fallback."""
    return [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
            for p in map(model.id_to_piece, range(model.get_piece_size()))]


class _Entries:
    """The bytes of a vocabulary, one after the other."""

    def __init__(self, entries: list[bytes]):
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        edge = np.concatenate([[0], np.cumsum(sizes)])
        return self.data[np.repeat(self.start[ids] - edge[:-1], sizes) + np.arange(edge[-1])]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ..., for each range in turn."""
    edge = np.concatenate([[0], np.cumsum(sizes)])
    return np.repeat(first - edge[:-1], sizes) + np.arange(edge[-1])


class _Index(dict):
    """Numbers pieces in the order they come; ``fresh`` collects those not aligned yet."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = k = len(self)
        self.fresh.append(piece)
        return k


_ALIGNERS: dict[tuple[str, str], "Aligner"] = {}


class Aligner:
    """Both tokenizers, and what is known of the pieces seen lately."""

    @classmethod
    def of(cls, path_a: str, path_b: str) -> "Aligner":
        """The task's aligner: this module travels with the task, and so does what it keeps."""
        if (path_a, path_b) not in _ALIGNERS:
            _ALIGNERS[path_a, path_b] = cls(path_a, path_b)
        return _ALIGNERS[path_a, path_b]

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        entries_b = piece_entries(self.b)
        self.entries_a, self.entries_b = _Entries(byte_level_entries(path_a)), _Entries(entries_b)
        self.width = len(entries_b)
        self._forget()

    def _forget(self) -> None:
        self.index, self.characters = _Index(), 0
        # per piece: tokens of A and B, groups, whether its bytes are spelt; its links from first[k] to first[k + 1]
        self.facts, self.used = np.zeros((1024, 4), np.int32), 0
        self.links, self.first = np.zeros(1 << 16, np.int64), np.zeros(1025, np.int64)
        self.texts: list[str] = []

    def _learn(self) -> None:
        pieces, self.index.fresh = self.index.fresh, []
        self.characters += sum(map(len, pieces))
        for low in range(0, len(pieces), 20_000):
            self._add(pieces[low:low + 20_000])

    def align(self, pieces: list[str]):
        """Of pieces that begin with a space: ids of A and of B, where each piece's begin, whether both spell it, and
        the common ends as (piece, i, j)."""
        a, a_first = _flat([e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)])
        b, b_first = _flat(self.b.encode([p[1:] for p in pieces], num_threads=1))
        raw = [p.encode() for p in pieces]
        want, size = np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))
        ends, right = [], np.ones(len(pieces), bool)
        for ids, first, entries in ((a, a_first, self.entries_a), (b, b_first, self.entries_b)):
            run = np.concatenate([[0], np.cumsum(entries.size[ids])])
            ends.append(run[1:] - np.repeat(run[first[:-1]], np.diff(first)))
            right &= run[first[1:]] - run[first[:-1]] == size
            spelt = entries.spell(ids)
            fit = np.flatnonzero(right)
            off = spelt[_ranges(run[first[:-1]][fit], size[fit])] != want[_ranges((np.cumsum(size) - size)[fit], size[fit])]
            right[np.repeat(fit, size[fit])[off]] = False
        return a, a_first, b, b_first, right, common_ends(ends[0], a_first, ends[1], b_first)

    def _add(self, pieces: list[str]) -> None:
        a, a_first, b, b_first, right, (piece, i, j) = self.align(pieces)
        groups = np.bincount(piece, minlength=len(pieces))
        begins = np.concatenate([[0], np.cumsum(groups)])[:-1]
        head = np.zeros(len(piece), bool)
        head[begins[groups > 0]] = True
        # a group reaches from behind the common end before it to its own
        i0 = np.where(head, a_first[piece], np.concatenate([[0], i[:-1] + 1]))
        j0 = np.where(head, b_first[piece], np.concatenate([[0], j[:-1] + 1]))
        n_a, n_b = i + 1 - i0, j + 1 - j0
        n_links = n_a * n_b
        of = np.repeat(np.arange(len(piece)), n_links)
        rank = _ranges(np.zeros(len(piece), np.int64), n_links)
        links = a[i0[of] + rank // n_b[of]] * self.width + b[j0[of] + rank % n_b[of]]
        need = self.used + len(pieces)
        while need > len(self.facts):
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
            self.first = np.concatenate([self.first, np.zeros(len(self.first) - 1, np.int64)])
        base = self.first[self.used]
        while base + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[base:base + len(links)] = links
        per_piece = np.bincount(piece, weights=n_links, minlength=len(pieces)).astype(np.int64)
        self.first[self.used + 1:need + 1] = base + np.cumsum(per_piece)
        self.facts[self.used:need] = np.stack([np.diff(a_first), np.diff(b_first), groups, right], axis=1)
        said_a, said_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        written = [
            f"{said_a[p] if q == p + 1 else ','.join(said_a[p:q])}|{said_b[r] if s == r + 1 else ','.join(said_b[r:s])}"
            for p, q, r, s in zip(i0.tolist(), (i + 1).tolist(), j0.tolist(), (j + 1).tolist())]
        edge = np.append(begins, len(piece)).tolist()
        self.texts += [";".join(written[p:q]) for p, q in zip(edge[:-1], edge[1:])]
        self.used = need

    def measure(self, texts: list[str | None]):
        """(n_a, n_b, n_groups, n_links) and the groups' hash of each text, its distinct links with their number of
        occurrences, and where each text's links begin."""
        parts = [_PIECES.findall(f" {t}") if t else [] for t in texts]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        at = np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(parts)), np.int64, int(counts.sum()))
        if self.index.fresh:
            self._learn()
        edge = np.concatenate([[0], np.cumsum(counts)])
        of = np.repeat(np.arange(len(texts)), counts)
        good = np.ones(len(texts), bool)
        good[of[self.facts[at, 3] == 0]] = False
        good &= counts > 0
        facts = np.zeros((len(texts), 3), np.int64)
        keep = good[of]
        for c in range(3):
            facts[:, c] = np.bincount(of[keep], weights=self.facts[at[keep], c], minlength=len(texts))
        sizes = (self.first[at + 1] - self.first[at])[keep]
        links = self.links[_ranges(self.first[at[keep]], sizes)]
        owner = np.repeat(of[keep], sizes)
        n_links = np.bincount(owner, minlength=len(texts))
        bits = int(max(1, (len(self.entries_a.size) * self.width - 1).bit_length()))
        if len(texts).bit_length() + bits > 63:
            raise OverflowError("vocabularies too large for one batch of texts")
        mixed, times = np.unique((owner << bits) | links, return_counts=True)
        links = mixed & ((1 << bits) - 1)
        first = np.searchsorted(mixed >> bits, np.arange(len(texts) + 1))
        at_list, said = at.tolist(), []
        for k in range(len(texts)):
            said.append(hashlib.sha256(";".join(map(self.texts.__getitem__, at_list[edge[k]:edge[k + 1]])).encode()).hexdigest() if good[k] else "")
        if len(self.index) > KEPT or self.characters > KEPT_CHARACTERS:
            self._forget()
        return np.column_stack([facts, n_links]), said, links, times, first


def _measured(path_a: str, path_b: str, kind: pa.DataType):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in text_runs(texts):
                facts, said, links, times, first = Aligner.of(path_a, path_b).measure(texts[low:high])
                offsets = pa.array(first, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(low, high - low), batch.column("doc_id").slice(low, high - low),
                     *(pa.array(facts[:, c], pa.int64()) for c in range(4)), pa.array(said, pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(links, kind)), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "times"])

    return measured


def _heavy_sums(pairs, counts, best):
    """Sums over links whose pair is among the heavy ones; the others are left as lists."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, top = pairs.value, counts.value, best.value
        for batch in batches:
            links, times = batch.column("links"), batch.column("times")
            first = links.offsets.to_numpy().astype(np.int64)
            pair, n = links.values.to_numpy()[first[0]:first[-1]], times.values.to_numpy()[first[0]:first[-1]].astype(np.int64)
            first = first - first[0]
            at = np.minimum(np.searchsorted(key, pair), max(0, len(key) - 1))
            known = key[at] == pair if len(key) else np.zeros(len(pair), bool)
            run = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[first])
            got = lambda x: np.where(known, x[at], 0) if len(key) else np.zeros(len(pair), np.int64)
            rare = np.concatenate([[0], np.cumsum(~known)])[first]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")),
                 pa.array(run(got(top) * n)), pa.array(run(got(count) * n)),
                 pa.ListArray.from_arrays(pa.array(rare, pa.int32()), pa.array(pair[~known], links.values.type)),
                 pa.ListArray.from_arrays(pa.array(rare, pa.int32()), pa.array(n[~known], pa.int32()))],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "best", "summed", "links", "times"])

    return sums


def align_documents(docs: DataFrame, path_a: str, path_b: str, heavy: int = HEAVY) -> DataFrame:
    """Of every document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``path_a`` names a byte-level vocabulary of the tokenizers library, ``path_b`` a sentencepiece model.
    """
    spark = docs.sparkSession
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    small = len(byte_level_entries(path_a)) * width <= 1 << 31
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    own = f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    facts = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    lists = f"links array<{'int' if small else 'bigint'}>, times array<int>"
    aligned = stored(texts.mapInArrow(_measured(path_a, path_b, pa.int32() if small else pa.int64()), f"{own}, {facts}, {lists}"), "aligned")
    # how many documents hold each pair; the most of any pair of an id of A
    held = stored(aligned.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    a_id = F.expr(f"pair div {width}")
    top = held.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    # one row for each id of A at most
    scored = stored(held.join(F.broadcast(top), a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")), "scored")
    # powers of two: at most 64 rows
    steps = scored.groupBy((F.length(F.bin("n")) - 1).alias("step")).agg(F.count("*").alias("pairs")).orderBy(F.desc("step")).collect()
    least, room = None, heavy
    for step, pairs in steps:
        room -= pairs
        if room < 0:
            break
        least = 1 << step
    common = scored.where(F.lit(False) if least is None else F.col("n") >= least).toArrow().sort_by("pair")
    shared = [spark.sparkContext.broadcast(common[c].to_numpy()) for c in ("pair", "n", "best")]
    partly = stored(aligned.mapInArrow(_heavy_sums(*shared), f"{own}, {facts}, best long, summed long, {lists}"), "partly")
    rare = partly.select("row", F.explode(F.arrays_zip("links", "times")).alias("l")).select("row", F.col("l.links").alias("pair"), F.col("l.times").alias("times"))
    rare = rare.join(scored if least is None else scored.where(F.col("n") < least), "pair").groupBy("row").agg(
        F.sum(F.col("best") * F.col("times")).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more"))
    zero = F.lit(0).cast("long")
    return partly.join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("summed") + F.coalesce("more", zero)).alias("count_sum"), "groups_sha256")
