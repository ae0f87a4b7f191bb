"""Benchmark decontamination by latent semantic retrieval, longest common subsequence and answer checks.

TF-IDF weights come from the whole corpus: the vocabulary of the benchmark is counted over all passages of
all documents. A distributed randomised SVD of the benchmark's passages gives a latent space; every window
of every document is folded into it, and windows near a benchmark passage by cosine are candidates. An item
longer than a window is cut into passages no longer than one, and the space has as many dimensions as there
are passages, so neither long items nor large benchmarks lose cosine. A candidate is a leak if the longest
common subsequence covers most of the item's words, or half of them together with the item's answer, its
last sentence: that catches paraphrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hirelattice.llm.common import stored
from hirelattice.llm.words import U64, Words, shingles, words_of

WINDOW, STEP = 32, 8
TASKS = 8  # that share the passes over the benchmark
NEAR = 0.42  # cosine of a candidate: a window that holds half of a passage has more
COVERED, HALF, ANSWER = 0.75, 0.5, 0.8
# items of fewer words are looked up as whole runs, and those of fewer than TINY as whole documents
SHORT, TINY = 12, 5
# benchmark passages handled at once; a larger benchmark takes as many passes over the documents
PASSAGES = 512


@dataclass
class Item:
    id: int
    words: np.ndarray
    answer: int  # where the last sentence begins


def read_items(rows: list) -> list[Item]:
    """Items of (id, text) rows that have words. The answer begins after the last sentence end before the
    final word; without one it is the last quarter of the words."""
    out = []
    for k, words in zip(rows, _each([r[1] for r in rows])):
        hashes, ends = words
        n = len(hashes)
        if n:
            stops = np.flatnonzero(ends[:-1]) + 1
            out.append(Item(k[0], hashes, int(stops[-1]) if len(stops) else n - max(1, n // 4)))
    return out


def _each(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for words in words_of(pa.array(texts, pa.string())):
        last = words.data[words.end - 1] if len(words.end) else np.zeros(0, np.uint8)
        ends = np.isin(last, np.frombuffer(b".!?", np.uint8))
        for low, high in zip(words.first[:-1], words.first[1:]):
            yield words.hash[low:high], ends[low:high]


class Vocabulary:
    """The distinct words of the items, found by hash; most other words are told by a table of 2**20 marks."""

    def __init__(self, items: list[Item]):
        self.words = np.unique(np.concatenate([i.words for i in items])) if items else np.zeros(0, U64)

    @cached_property
    def mark(self) -> np.ndarray:
        mark = np.zeros(1 << 20, bool)
        mark[(self.words >> U64(44)).astype(np.int64)] = True
        return mark

    def __getstate__(self) -> dict:
        return {"words": self.words}  # every task marks for itself

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each word, -1 for others."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.mark[(hashes >> U64(44)).astype(np.int64)])
        at = np.searchsorted(self.words, hashes[maybe])
        at[at == len(self.words)] = 0
        right = self.words[at] == hashes[maybe] if len(self.words) else np.zeros(0, bool)
        out[maybe[right]] = at[right]
        return out


def passage_counts(documents: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """In how many passages of ``WINDOW`` words of all documents each word of the vocabulary occurs, and how many there are.

    At most one row for each word of the vocabulary reaches the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, passages = np.zeros(len(vocabulary.words), np.int64), 0
        for batch in batches:
            for words in words_of(batch.column("text")):
                per_text = -(-words.counts // WINDOW)
                first = np.cumsum(per_text) - per_text
                place = np.arange(len(words.hash)) - np.repeat(words.first[:-1], words.counts)
                passage = np.repeat(first, words.counts) + place // WINDOW
                found = vocabulary.find(words.hash)
                known = found >= 0
                pairs = np.unique(passage[known] * len(seen) + found[known])
                seen += np.bincount(pairs % max(1, len(seen)), minlength=len(seen))
                passages += int(per_text.sum())
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(seen[used], passages))], names=["word", "n"])

    sums = documents.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out, passages = np.zeros(len(vocabulary.words), np.int64), 0
    for row in sums.collect():
        if row["word"] < 0:
            passages = row["n"]
        else:
            out[row["word"]] = row["n"]
    return out, passages


def _passages(item: Item) -> list[np.ndarray]:
    """The words of an item in equal parts of ``WINDOW`` words at most."""
    return np.array_split(item.words, -(-len(item.words) // WINDOW))


def _rows_of(passages: list[np.ndarray], vocabulary: Vocabulary, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """TF-IDF rows of passages, of unit length."""
    out = []
    for passage in passages:
        at, tf = np.unique(vocabulary.find(passage), return_counts=True)
        weight = tf * idf[at]
        out.append((at, weight / max(1e-12, np.sqrt((weight * weight).sum()))))
    return out


def latent_space(benchmark: DataFrame, items: list[Item], vocabulary: Vocabulary, idf: np.ndarray, seed: int = 5) -> np.ndarray:
    """Right singular vectors (words x rank) of the TF-IDF matrix A of the passages of ``benchmark(item_id, text)`` by a distributed randomised SVD.

    ``items`` are those of the benchmark, whose rows in the space found turn it to the singular vectors.

    The rank is that of A, so passages keep their whole norm, and A'(A R) for one random R, which every task draws
    from the seed, spans all of their space. Tasks send the rows of the words they hold; these are summed per word in
    Spark, so that the driver gets one matrix of words x rank, which ``PASSAGES`` bounds.
    """
    rank = min(sum(len(_passages(i)) for i in items), len(vocabulary.words))
    rows = benchmark.select("item_id", "text").coalesce(TASKS)

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis = np.random.default_rng(seed).normal(size=(len(vocabulary.words), rank))
        total, held = np.zeros_like(basis), np.zeros(len(basis), bool)
        for batch in batches:
            found = read_items(list(zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist())))
            for at, weight in _rows_of([p for item in found for p in _passages(item)], vocabulary, idf):
                total[at] += weight[:, None] * (weight @ basis[at])
                held[at] = True
        word = np.flatnonzero(held)
        for low in range(0, len(word), 512):
            part = word[low:low + 512]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([total[w].tobytes() for w in part], pa.binary())], names=["word", "m"])

    def added(table: pa.Table) -> pa.Table:
        word, at = np.unique(table.column("word").to_numpy(), return_inverse=True)
        total = np.zeros((len(word), rank))
        for k, m in zip(at, table.column("m")):
            total[k] += np.frombuffer(m.as_py())
        return pa.table({"word": pa.array(word), "m": pa.array([t.tobytes() for t in total], pa.binary())})

    sums = rows.mapInArrow(ranged, "word long, m binary").groupBy((F.col("word") % TASKS).alias("part")).applyInArrow(added, "word long, m binary")
    spread = np.zeros((len(vocabulary.words), rank))
    for row in sums.toLocalIterator():
        spread[row["word"]] = np.frombuffer(bytes(row["m"]))
    basis = np.linalg.qr(spread)[0]
    total = np.zeros((rank, rank))
    for at, weight in _rows_of([p for item in items for p in _passages(item)], vocabulary, idf):
        y = weight @ basis[at]
        total += np.outer(y, y)
    values, vectors = np.linalg.eigh(total)
    return (basis @ vectors[:, values > 1e-9 * max(1e-300, values.max())]).astype(np.float32)


def common_subsequence(pattern: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of one integer (one per word of the pattern)."""
    masks: dict[int, int] = {}
    for k, word in enumerate(pattern.tolist()):
        masks[word] = masks.get(word, 0) | 1 << k
    full = (1 << len(pattern)) - 1
    row = full
    for word in text.tolist():
        mask = masks.get(word)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return len(pattern) - row.bit_count()


class Index:
    """Everything a task needs to find leaks of some items."""

    def __init__(self, items: list[Item], vocabulary: Vocabulary, idf: np.ndarray, space: np.ndarray):
        self.items, self.vocabulary = items, vocabulary
        self.idf = np.append(idf, np.median(idf) if len(idf) else 0.0).astype(np.float32)  # the last is for other words
        # an item's whole row lies in the space of its passages; a window may be near to either
        near = [(i, p) for i in items if len(i.words) >= SHORT for p in [i.words, *(_passages(i) if len(i.words) > WINDOW else [])]]
        self.long = [i for i, _ in near]
        rows = _rows_of([p for _, p in near], vocabulary, idf)
        latent = np.stack([w @ space[at] for at, w in rows]).astype(np.float32) if rows else np.zeros((0, space.shape[1]), np.float32)
        latent /= np.maximum(1e-12, np.sqrt((latent * latent).sum(axis=1, keepdims=True)))
        # what one occurrence of a word adds to the inner products of a window with the items
        self.scores = (space * self.idf[:-1, None]) @ latent.T
        self.runs: dict[int, dict[int, list[int]]] = {}
        for item in items:
            n = len(item.words)
            if n < SHORT:
                one = Words(slice(0, 1), None, item.words, None, None, np.array([0, n]), None)
                self.runs.setdefault(n, {}).setdefault(int(shingles(one, n, False)[0][0]), []).append(item.id)

    def leaks(self, words: Words) -> Iterator[tuple[int, int]]:
        """(text, item) of the leaks among the words of some texts; each pair once."""
        yield from self._runs(words)
        if not self.scores.size or not len(words.hash):
            return
        found = self.vocabulary.find(words.hash)
        weight = self.idf[found]
        power = np.concatenate([[0], np.cumsum((weight * weight).astype(np.float64))])
        known = np.concatenate([[0], np.cumsum(np.where(found >= 0, weight * weight, 0).astype(np.float64))])
        # windows begin every STEP words of a text; the last ones are shorter
        per_text = -(-words.counts // STEP)
        begin = np.cumsum(per_text) - per_text
        text = np.repeat(np.arange(len(per_text)), per_text)
        low = words.first[text] + STEP * (np.arange(len(text)) - begin[text])
        high = np.minimum(low + WINDOW, words.first[text + 1])
        whole = power[high] - power[low]
        # the part of a window that the space can hold bounds its cosine
        some = np.flatnonzero(known[high] - known[low] >= NEAR * NEAR * whole)
        for part in range(0, len(some), 2048):
            at = some[part:part + 2048]
            # a window is as many steps of its text; each step is added up once for all windows that hold it
            steps = np.unique((at[:, None] + np.arange(WINDOW // STEP)).ravel())
            steps = steps[steps < len(text)]
            sums = np.zeros((len(steps) + 1, self.scores.shape[1]), np.float32)
            for k in range(STEP):
                spot = low[steps] + k
                word = np.where(spot < high[steps], found[np.minimum(spot, len(found) - 1)], -1)
                have = np.flatnonzero(word >= 0)
                sums[have] += self.scores[word[have]]
            near = np.zeros((len(at), sums.shape[1]), np.float32)
            for k in range(WINDOW // STEP):
                own = np.searchsorted(steps, np.minimum(at + k, len(text) - 1))
                # the last row is for steps beyond the text
                near += sums[np.where((at + k < len(text)) & (text[np.minimum(at + k, len(text) - 1)] == text[at]), own, len(steps))]
            # the norm is that of distinct words at least
            maybe = np.flatnonzero(near.max(axis=1) >= NEAR * np.sqrt(whole[at]) * (1 - 1e-5))
            at, near = at[maybe], near[maybe]
            spot = low[at][:, None] + np.arange(WINDOW)
            inside = spot < high[at][:, None]
            spot = np.minimum(spot, len(words.hash) - 1)
            # a word that occurs n times adds n times its weight, so n * n squares
            hashes = words.hash[spot]
            times = ((hashes[:, :, None] == hashes[:, None, :]) & inside[:, None, :]).sum(axis=2)
            norm = np.sqrt(np.where(inside, weight[spot] ** 2 * times, 0).sum(axis=1))
            cosine = near / np.maximum(norm, 1e-6)[:, None].astype(np.float32)
            rows, items = np.nonzero(cosine >= NEAR)
            done: set[tuple[int, int]] = set()
            for r, i in zip(rows.tolist(), items.tolist()):
                t = int(text[at[r]])
                if (t, self.long[i].id) not in done and self._confirmed(self.long[i], words, t, int(low[at[r]])):
                    done.add((t, self.long[i].id))
                    yield t, self.long[i].id

    def _confirmed(self, item: Item, words: Words, text: int, low: int) -> bool:
        n = len(item.words)
        around = words.hash[max(words.first[text], low - n):min(words.first[text + 1], low + WINDOW + n)]
        # no subsequence has more of the passage's words than occur there at all
        if np.isin(item.words, around).sum() < HALF * n:
            return False
        share = common_subsequence(item.words, around) / n
        if share >= COVERED or share < HALF:
            return share >= COVERED
        answer = item.words[item.answer:]
        return common_subsequence(answer, around) >= ANSWER * len(answer)

    def _runs(self, words: Words) -> Iterator[tuple[int, int]]:
        for n, wanted in self.runs.items():
            hashes, first = shingles(words, n, False)
            for at in np.flatnonzero(np.isin(hashes, np.array(list(wanted), U64))):
                text = int(np.searchsorted(first, at, "right") - 1)
                if n >= TINY or words.counts[text] == n:
                    for item in wanted[int(hashes[at])]:
                        yield text, item


def _finder(index: Index):
    def leaked(text: pa.Array) -> pa.Array:
        out: list[list[int]] = []
        for words in words_of(text):
            found: list[set[int]] = [set() for _ in range(len(words.first) - 1)]
            for t, item in index.leaks(words):
                found[t].add(item)
            out.extend(sorted(f) for f in found)
        return pa.array(out, pa.list_(pa.int64()))

    return F.arrow_udf(leaked, "array<long>")


def finders(documents: DataFrame, benchmark: DataFrame) -> list:
    """Functions of a text column that name the leaked items, one for each ``PASSAGES`` passages of ``benchmark(item_id, text)``.

    Items without an id, a text or words match nothing. Repeated items are looked for once.
    """
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    items = stored(items, "items")
    n_words = F.size(F.split("text", r"[\x20\x09-\x0D]+"))
    blocks = max(1, -(-(items.agg(F.sum(F.ceil(n_words / WINDOW))).first()[0] or 0) // PASSAGES))
    out = []
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        found = read_items([tuple(r) for r in mine.orderBy("item_id", "text").collect()])  # about PASSAGES passages
        if not found:
            continue
        vocabulary = Vocabulary(found)
        counts, passages = passage_counts(documents, vocabulary)
        idf = np.log((1.0 + passages) / (1.0 + counts)) + 1.0
        out.append(_finder(Index(found, vocabulary, idf, latent_space(mine, found, vocabulary, idf))))
    return out


def leaked_items(documents: DataFrame, benchmark: DataFrame):
    """The ids of the leaked items as a column of ``documents``: an array, empty for clean, empty and null texts."""
    parts = [find(F.col("text")) for find in finders(documents, benchmark)]
    none = F.expr("cast(array() as array<bigint>)")
    return F.array_sort(F.array_distinct(F.concat(*parts))) if parts else none


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, items`` for every row of ``documents(doc_id, text)``."""
    found = documents.select("doc_id", leaked_items(documents, benchmark).alias("items"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items")


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the rows that hold a benchmark passage; all columns stay as they are."""
    return documents.where(F.size(leaked_items(documents, benchmark)) == 0)
