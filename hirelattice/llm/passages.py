"""Repeated passages: paragraph MinHash banding, exact verification, one occurrence kept.

Every run of ``WINDOW`` consecutive five-word shingles is a paragraph, wherever it begins. Its MinHash is
the least hash among its shingles: one band of one row, the banding of highest recall, as two paragraphs
collide with the chance of their similarity and one passage holds many paragraphs. Neighbours mostly share
their minimum, which is stored once (an anchor), so anchors number about two in ``WINDOW`` words and still
any common passage of ``WINDOW + 4`` words has one in both documents.

Equal passages are found whole: around anchors that several documents have, every stretch of ``LEAST_WORDS``
words goes by its hash to the lowest document that has all of them, so a document that holds a part of a
passage, or one of its phrases, hides no copy of the whole. Stretches inside a run (see below) need no hash.

For edited passages an anchor's owner is the lowest document that has it; other documents are compared with
the owner only, so a passage of any number of copies costs a row each. Anchors that lie equally far apart in both texts,
with equal words between them, make a run; a run is widened word by word on both sides; runs a few words
apart, after an edit, are joined if the Jaccard similarity of the shingles stays at 0.75 or more. Spans of
``LEAST_WORDS`` or more are removed from every document but the owner.

A word or phrase said over and over has the same anchor again and again, a ladder. Only its ends are compared with the
owner, and the places about as far from the end as the owner's is: from all others a span ends inside the ladder, where nothing
can follow it, and what is equal there is found by its stretches, which a text tells once with the reach of their repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hirelattice.llm.common import connected_components, discard, stored, unused
from hirelattice.llm.words import U64, Words, mix, powers, shingles, words_of

WINDOW = 32
LEAST_WORDS = 40
# words looked at on either side of a run: between two anchors lie fewer
MARGIN = 48
# words that an edit between two runs may take in either text
EDIT = 8
# anchors by which two ladders may differ in what is left of them and still be met
LADDER = EDIT + 4


def _slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``width`` (a power of two) consecutive values, by doubling."""
    step = 1
    while step < width:
        values = pick(values[:len(values) - step], values[step:])
        step *= 2
    return values


def anchors(items: np.ndarray, first: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """True at items that are the least of some ``window`` neighbours of their text (of the text, if it has fewer)."""
    out = np.zeros(len(items), bool)
    counts = np.diff(first)
    if len(items) >= window:
        least = _slide(items, window, np.minimum)
        inside = np.zeros(len(least), bool)
        for low, n in zip(first[:-1][counts >= window], counts[counts >= window]):
            inside[low:low + n - window + 1] = True
        least = np.where(inside, least, U64(0))
        padded = np.concatenate([np.zeros(window - 1, U64), least, np.zeros(window - 1, U64)])
        out = (_slide(padded, window, np.maximum) == items) & (items > 0)
    for low, n in zip(first[:-1], counts):
        if 0 < n < window:
            out[low:low + n] = items[low:low + n] == items[low:low + n].min()
    return out


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in words_of(batch.column("text")):
            items, first = shingles(words, whole=False)
            run = np.concatenate([np.zeros(1, U64), np.cumsum(mix(words.hash, 3) * _odd(words), dtype=U64)])
            at = np.flatnonzero(anchors(items, first))
            text = np.searchsorted(first, at, "right") - 1
            enough = words.counts[text] >= LEAST_WORDS
            at, text = at[enough], text[enough]
            pos = at - first[text]
            new = np.ones(len(at), bool)
            new[1:] = text[1:] != text[:-1]
            prev = np.where(new, -1, np.concatenate([[0], pos[:-1]]))
            word = words.first[text] + pos
            before = words.first[text] + np.maximum(prev, 0)
            gap = mix((run[word] - run[before]) * _unodd(before), 5)
            inner, rest = ladders(items[at], gap, new)
            ids = batch.column("doc_id").slice(words.rows.start, len(first) - 1).take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(items[at].view(np.int64)), pa.array(pos.astype(np.int32)), pa.array(prev.astype(np.int32)), pa.array(gap.view(np.int64)),
                 pa.array(rest.astype(np.int32)), pa.array(inner)], names=["doc", "key", "pos", "prev", "gap", "rest", "inner"])


def ladders(keys: np.ndarray, gaps: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an anchor lies inside a ladder (the same key before and after it, with the same words between), and how many of the ladder
    follow it; ``new`` marks the first anchor of a text."""
    n = len(keys)
    again = np.zeros(n + 1, bool)
    again[1:n] = (keys[1:] == keys[:-1]) & ~new[1:]
    inner = again[:n] & again[1:]
    inner[:-1] &= gaps[:-1] == gaps[1:]
    ends = np.flatnonzero(~inner)
    after = np.append(ends, n)[np.searchsorted(ends, np.arange(n), "right")]
    return inner, np.where(again[1:], after - np.arange(n), 0)


_ODD, _EVEN_OUT = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)


def _odd(words: Words) -> np.ndarray:
    """Powers that make the sum over a stretch of words depend on their order."""
    return powers(_ODD, len(words.hash) + 1)[:len(words.hash)]


def _unodd(at: np.ndarray) -> np.ndarray:
    return powers(_EVEN_OUT, int(at.max(initial=0)) + 1)[at]


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Margins of the asked (pos, key) of each text, and its stretches of ``LEAST_WORDS`` words that hold one of ``keys``.

    A margin is the 32-bit hashes of the words before pos, nearest first, and of those after the shingle; 0 stands
    for no word. An anchor that the text does not have there (another text of the same id) is left out. A stretch
    is told if its least shingle is among the keys: equal stretches have the same one. Those inside a run that is
    ``equal`` in a lower document are left out: that document has them too, so this one never is the lowest.
    """
    for batch in batches:
        ids, wanted_in, keys_in, equal_in = batch.column("doc_id"), batch.column("asked").to_pylist(), batch.column("keys"), batch.column("equal").to_pylist()
        for words in words_of(batch.column("text")):
            items, first = shingles(words, whole=False)
            small = np.maximum((words.hash >> U64(32)).astype(np.uint32), 1)
            rows, pos_out, back_out, ahead_out = [], [], [], []
            for i, wanted in enumerate(wanted_in[words.rows]):
                low, high = words.first[i], words.first[i + 1]
                for ask in wanted:
                    pos, n = ask["pos"], first[i + 1] - first[i]
                    if pos >= n or int(items[first[i] + pos].view(np.int64)) != ask["key"]:
                        continue
                    back, ahead = np.zeros(MARGIN, np.uint32), np.zeros(MARGIN, np.uint32)
                    left = small[max(low, low + pos - MARGIN):low + pos][::-1]
                    right = small[low + pos + 5:min(high, low + pos + 5 + MARGIN)]
                    back[:len(left)], ahead[:len(right)] = left, right
                    rows.append(i)
                    pos_out.append(pos)
                    back_out.append(back.tobytes())
                    ahead_out.append(ahead.tobytes())
            own = ids.slice(words.rows.start, len(first) - 1)
            none = lambda kind, n: pa.nulls(n, kind)
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [own.take(pa.array(rows, pa.int64())), pa.array(pos_out, pa.int32()), pa.array(back_out, pa.binary()), pa.array(ahead_out, pa.binary()),
                 none(pa.int32(), n), none(pa.int64(), n), none(pa.int32(), n)], names=_TOLD)
            keys = keys_in.slice(words.rows.start, len(first) - 1).flatten().to_numpy(zero_copy_only=False).view(U64)
            text, start, value, more = _repeats(*_stretches(words, items, first, keys, equal_in[words.rows]))
            n = len(text)
            yield pa.RecordBatch.from_arrays(
                [own.take(pa.array(text)), none(pa.int32(), n), none(pa.binary(), n), none(pa.binary(), n),
                 pa.array(start.astype(np.int32)), pa.array(value.view(np.int64)), pa.array(more.astype(np.int32))], names=_TOLD)


_TOLD = ["doc", "pos", "back", "ahead", "start", "stretch", "more"]


def _repeats(text: np.ndarray, start: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first start and hash of the stretches that a text says again without a break, and how far on the last of them starts."""
    order = np.lexsort((start, value, text))
    text, start, value = text[order], start[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1]) | (start[1:] - start[:-1] > LEAST_WORDS)
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(text)) - 1
    return text[low], start[low], value[low], start[high] - start[low]


def _stretches(words: Words, items: np.ndarray, first: np.ndarray, keys: np.ndarray, equal: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and hash of every run of ``LEAST_WORDS`` words whose least shingle is one of ``keys``, but for those in ``equal`` runs."""
    width = LEAST_WORDS - 4
    none = np.zeros(0, np.int64)
    if len(items) < width or not len(keys):
        return none, none, np.zeros(0, U64)
    least = _slide(items, WINDOW, np.minimum)
    least = np.minimum(least[:len(items) - width + 1], least[width - WINDOW:])
    told = np.isin(least, np.unique(keys))
    for low, n, runs in zip(first[:-1], np.diff(first), equal):
        for r in runs:
            ends = (r["low"], r["low_key"]), (r["high"], r["high_key"])
            if r["high"] < n and all(int(items[low + p].view(np.int64)) == k for p, k in ends):
                told[low + r["low"]:low + r["high"] - LEAST_WORDS + 6] = False
    at = np.flatnonzero(told)
    text = np.searchsorted(first, at, "right") - 1
    inside = at + width <= first[text + 1]
    at, text = at[inside], text[inside]
    start = at - first[text]
    run = np.concatenate([np.zeros(1, U64), np.cumsum(mix(words.hash, 3) * _odd(words), dtype=U64)])
    word = words.first[text] + start
    return text, start, mix((run[word + LEAST_WORDS] - run[word]) * _unodd(word), 9)


def _common(a: pa.Array, b: pa.Array) -> pa.Array:
    """How many words two margins have in common from their beginning."""
    x, y = (np.frombuffer(b"".join(v.as_py() for v in side), np.uint32).reshape(-1, MARGIN) for side in (a, b))
    differ = np.concatenate([(x != y) | (x == 0), np.ones((len(x), 1), bool)], axis=1)
    return pa.array(differ.argmax(axis=1).astype(np.int32))


def repeated_spans(documents: DataFrame) -> DataFrame:
    """Stored ``doc, start, stop, owner, owner_start``: word spans of ``documents(doc_id, text)`` that a lower document has too.

    Rows without an id or with fewer than ``LEAST_WORDS`` words have none; repeats within one document stay.
    """
    texts = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(texts.mapInArrow(_anchor_rows, "doc long, key long, pos int, prev int, gap long, rest int, inner boolean"), "anchors")
    owners = stored(rows.groupBy("key").agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).where("owner <> last").drop("last"), "owners")
    hits = stored(rows.join(owners, "key"), "hits")
    _discard_all(rows, owners)
    # an owner with the anchor at several places offers the first
    place = F.struct("pos", "prev", "gap", "rest")
    own = stored(hits.where("doc = owner").groupBy(F.col("key").alias("own_key")).agg(F.min(place).alias("own")).select(
        "own_key", *(F.col(f"own.{c}").alias(f"own_{c}") for c in ("pos", "prev", "gap", "rest"))), "own")
    level = (F.col("key") == F.col("own_key")) & (~F.col("inner") | (F.abs(F.col("rest") - F.col("own_rest")) <= LADDER))
    pairs = hits.where("doc <> owner").join(own, level).withColumn("shift", F.col("pos") - F.col("own_pos"))
    line = Window.partitionBy("doc", "owner", "shift").orderBy("pos")
    same = (F.lag("pos").over(line) == F.col("prev")) & (F.col("prev") - F.col("own_prev") == F.col("shift")) & (F.col("gap") == F.col("own_gap")) & (F.col("own_prev") >= 0)
    runs = pairs.withColumn("new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("new").over(line))
    # an anchor so deep in a run that all stretches around it are equal in the owner needs none of them told
    inside = LEAST_WORDS - 5
    open_keys = f"transform(filter(held, a -> a.pos < low + {inside} or a.pos > high - {inside}), a -> a.key)"
    runs = stored(runs.groupBy("doc", "owner", "shift", "run").agg(
        F.min("pos").alias("low"), F.max("pos").alias("high"), F.min_by("key", "pos").alias("low_key"), F.max_by("key", "pos").alias("high_key"),
        F.collect_list(F.struct("pos", "key")).alias("held")).withColumn("open", F.expr(open_keys)).drop("held"), "runs")
    end = lambda doc, pos, key: F.expr(f"named_struct('d', {doc}, 'p', {pos}, 'k', {key})")
    ends = F.inline(F.array(end("doc", "low", "low_key"), end("doc", "high", "high_key"), end("owner", "low - shift", "low_key"), end("owner", "high - shift", "high_key")))
    kinds = {"end": "struct<pos:int,key:bigint>", "key": "bigint", "equal": "struct<low:int,high:int,low_key:bigint,high_key:bigint>"}
    one = lambda df, kind, value: df.select(F.col("d"), *(value.alias(k) if k == kind else F.lit(None).cast(t).alias(k) for k, t in kinds.items()))
    asked = one(runs.select(ends).distinct(), "end", F.struct(F.col("p").alias("pos"), F.col("k").alias("key")))
    wanted = stored(runs.select(F.explode("open").alias("key")).distinct(), "open")
    asked = asked.union(one(hits.where("not inner").select(F.col("doc").alias("d"), "key").join(wanted, "key"), "key", F.col("key")))
    asked = asked.union(one(runs.where(f"high - low >= {inside}").withColumnRenamed("doc", "d"), "equal", F.struct("low", "high", "low_key", "high_key")))
    asked = asked.groupBy(F.col("d").alias("doc_id")).agg(F.collect_list("end").alias("asked"), F.collect_set("key").alias("keys"), F.collect_list("equal").alias("equal"))
    told = texts.join(asked, "doc_id").select("doc_id", "text", "asked", "keys", "equal")
    told = stored(told.mapInArrow(_told, "doc long, pos int, back binary, ahead binary, start int, stretch long, more int"), "told")
    _discard_all(hits, own, wanted)
    # rows that share an id and text tell the same again
    margins = stored(told.where("pos is not null").groupBy(F.col("doc").alias("doc_id"), "pos").agg(F.max("back").alias("back"), F.max("ahead").alias("ahead")), "margins")
    back = lambda doc, pos, name: margins.select(F.col("doc_id").alias(doc), F.col("pos").alias(pos), F.col("back").alias(name))
    ahead = lambda doc, pos, name: margins.select(F.col("doc_id").alias(doc), F.col("pos").alias(pos), F.col("ahead").alias(name))
    placed = runs.withColumns({"own_low": F.col("low") - F.col("shift"), "own_high": F.col("high") - F.col("shift")})
    met = placed.join(back("doc", "low", "a"), ["doc", "low"]).join(back("owner", "own_low", "b"), ["owner", "own_low"])
    met = met.join(ahead("doc", "high", "c"), ["doc", "high"]).join(ahead("owner", "own_high", "d"), ["owner", "own_high"])
    common = F.arrow_udf(_common, "int")
    wide = met.withColumns({"left": common("a", "b"), "right": common("c", "d")}).select(
        "doc", "owner", "shift", (F.col("low") - F.col("left")).alias("start"), (F.col("high") + 5 + F.col("right")).alias("stop"))
    wide = stored(wide.groupBy("doc", "owner", "shift", "start").agg(F.max("stop").alias("stop")), "wide")
    _discard_all(margins, runs)
    near = Window.partitionBy("doc", "owner").orderBy("start", "stop", "shift")
    gap, own_gap = F.col("start") - F.lag("stop").over(near), (F.col("start") - F.col("shift")) - (F.lag("stop").over(near) - F.lag("shift").over(near))
    glue = gap.between(-4, EDIT) & own_gap.between(-4, EDIT)
    chains = wide.withColumn("new", F.when(F.coalesce(glue, F.lit(False)), 0).otherwise(1)).withColumn("chain", F.sum("new").over(near))
    words = lambda low, high: F.max(high) - F.min(low)
    begin, end = F.col("start") - F.col("shift"), F.col("stop") - F.col("shift")
    joined = chains.groupBy("doc", "owner", "chain").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min(begin).alias("owner_start"), words(begin, end).alias("owner_words"),
        F.sum(F.col("stop") - F.col("start") - 4).alias("common"))
    whole = joined.where(f"stop - start >= {LEAST_WORDS} and 100 * common >= 75 * (stop - start - 4 + owner_words - 4 - common)")
    # parts of an edited chain that is not alike as a whole count on their own
    alone = chains.where(f"stop - start >= {LEAST_WORDS}").select("doc", "start", "stop", "owner", begin.alias("owner_start"))
    found = whole.select("doc", "start", "stop", "owner", "owner_start").union(alone).union(_equal_spans(told))
    spans = stored(found.distinct(), "spans")
    _discard_all(told, wide)
    return spans


def _discard_all(*tables: DataFrame) -> None:
    for table in tables:
        discard(table)


def _equal_spans(told: DataFrame) -> DataFrame:
    """``doc, start, stop, owner, owner_start`` of all stretches that a lower document has, whoever owns their anchors.

    A stretch's owner is the lowest document with all its words, at its first place; consecutive stretches make a span.
    """
    place = told.where("stretch is not null").select("doc", "start", "stretch", "more")
    lowest = place.groupBy("stretch").agg(F.min(F.struct("doc", "start")).alias("o"), F.max("doc").alias("last")).where("o.doc <> last")
    lowest = stored(lowest.select("stretch", F.col("o.doc").alias("owner"), F.col("o.start").alias("owner_start")), "stretches")
    held = place.join(lowest, "stretch").where("doc <> owner").select("doc", "owner", (F.col("start") - F.col("owner_start")).alias("shift"), "start", "more")
    line = Window.partitionBy("doc", "owner", "shift").orderBy("start")
    # rows that share an id tell a start again
    run = held.withColumn("run", F.col("start") - F.dense_rank().over(line))
    spans = run.groupBy("doc", "owner", "shift", "run").agg(F.min("start").alias("start"), (F.max(F.col("start") + F.col("more")) + LEAST_WORDS).alias("stop"))
    return spans.select("doc", "start", "stop", "owner", (F.col("start") - F.col("shift")).alias("owner_start"))


def merged_spans(spans: DataFrame) -> DataFrame:
    """``doc, cuts``: the disjoint word spans of each document in order, as an array of (start, stop)."""
    line = Window.partitionBy("doc").orderBy("start", "stop")
    reach = F.max("stop").over(line.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("part", F.sum("new").over(line))
    parts = marked.groupBy("doc", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return parts.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("cuts"))


def _without(text: pa.Array, cuts: pa.Array) -> pa.Array:
    """The text without the words of the cuts and the white space after each."""
    out, texts, cuts = [], text.to_pylist(), cuts.to_pylist()
    todo = [i for i, c in enumerate(cuts) if c and texts[i] is not None]
    part = pa.array([texts[i] for i in todo], pa.string())
    out = list(texts)
    for words in words_of(part):
        for k, i in enumerate(todo[words.rows]):
            data, low, n = texts[i].encode(), words.first[k], words.first[k + 1] - words.first[k]
            kept, at = [], 0
            for cut in cuts[i]:
                if cut["stop"] > n:
                    continue
                kept.append(data[at:int(words.start[low + cut["start"]] - words.base[k])])
                at = int(words.start[low + cut["stop"]] - words.base[k]) if cut["stop"] < n else len(data)
            out[i] = b"".join([*kept, data[at:]]).decode()
    return pa.array(out, pa.string())


def remove_repeats(documents: DataFrame) -> DataFrame:
    """``documents`` with every repeated passage left in its owner only; ``n_chars`` follows where there is one.

    No row goes, other columns stay as they are, and a text without repeats is the same string.
    """
    doc, found = unused(documents, "_doc"), unused(documents, "_cuts")
    cuts = stored(merged_spans(repeated_spans(documents)), "cuts").toDF(doc, found)
    out = documents.join(cuts, F.col("doc_id") == F.col(doc), "left")
    changed = F.col(found).isNotNull()
    out = out.withColumn("text", F.when(changed, F.arrow_udf(_without, "string")("text", found)).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(documents.columns)


def repeat_report(documents: DataFrame) -> DataFrame:
    """``doc_id, removed_words, removed_spans, owners, component_id`` for every row of ``documents``.

    ``removed_spans`` are (start, stop) in words, ``owners`` the documents that keep the passages, and
    ``component_id`` the lowest document that is connected by repeated passages (itself without any).
    """
    spans = repeated_spans(documents)
    cuts = merged_spans(spans)
    owners = spans.groupBy("doc").agg(F.array_sort(F.collect_set("owner")).alias("owners"))
    groups = connected_components(spans.select(F.col("doc").alias("a"), F.col("owner").alias("b"))).toDF("doc", "component")
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    found = groups.join(cuts, "doc", "left").join(owners, "doc", "left").withColumnRenamed("doc", "doc_id")
    out = ids.join(found, "doc_id", "left")
    none = F.expr("cast(array() as array<struct<start:int,stop:int>>)")
    return out.select(
        "doc_id", F.expr("aggregate(coalesce(cuts, cast(array() as array<struct<start:int,stop:int>>)), 0L, (s, c) -> s + c.stop - c.start)").alias("removed_words"),
        F.coalesce("cuts", none).alias("removed_spans"), F.coalesce("owners", F.expr("cast(array() as array<bigint>)")).alias("owners"),
        F.coalesce("component", "doc_id").alias("component_id"))
