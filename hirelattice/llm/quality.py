"""Quality score of a text by a byte-level convolutional network in numpy.

Every UTF-8 byte has a learned vector; learned filters run over windows of eight bytes, two bytes apart,
through the whole text. Their responses are max-pooled and averaged over overlapping chunks of 512 bytes
that cover the text, a hidden layer judges each chunk, and the mean and the maximum of these judgements
over all chunks make one probability. Nothing but the bytes goes in.

The network is fitted by Adam on a bounded sample: at most ``rows`` labelled texts, half of them from each
class where there are so many, the lowest by a hash of their id. A text of more than ``SECTIONS`` chunks gives a
chunk from a drawn place in each of as many equal parts, so that all of it can be learned from. Scoring reads whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hirelattice.llm.words import buffers, slices

BLOCK, CHUNK_BLOCKS, CHUNK_STEP = 64, 8, 7
DIM, WIDTH, FILTERS, HIDDEN, HOP = 6, 8, 24, 24, 2
PAD = 256
TRAIN_ROWS, SECTIONS, STEPS = 2560, 7, 540

Network = dict[str, np.ndarray]


def fresh(seed: int = 7) -> Network:
    """Random filters and a last layer of zeros, which gives every text 0.5."""
    draw = np.random.default_rng(seed)
    make = lambda scale, *shape: draw.normal(0, scale, shape).astype(np.float32)
    table = make(0.6, PAD + 1, DIM)
    table[PAD] = 0
    return {"table": table, "filters": make((WIDTH * DIM) ** -0.5, WIDTH * DIM, FILTERS), "offset": np.zeros(FILTERS, np.float32),
            "hidden": make((2 * FILTERS) ** -0.5, 2 * FILTERS, HIDDEN), "shift": np.full(HIDDEN, 0.1, np.float32),
            "last": np.zeros(2 * HIDDEN, np.float32), "bias": np.zeros(1, np.float32)}


def _layout(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Texts side by side, each padded to whole blocks with a window's width to spare, and the chunks of each."""
    sizes = np.diff(at)
    blocks = -(-(sizes + WIDTH) // BLOCK)
    begin = np.concatenate([[0], np.cumsum(blocks)])
    codes = np.full(begin[-1] * BLOCK + WIDTH, PAD, np.int64)
    codes[np.repeat(begin[:-1] * BLOCK - (at[:-1] - at[0]), sizes) + np.arange(at[-1] - at[0])] = data[at[0]:at[-1]]
    chunks = np.maximum(1, -(-(blocks - 1) // CHUNK_STEP))
    first = np.concatenate([[0], np.cumsum(chunks)])
    text = np.repeat(np.arange(len(sizes)), chunks)
    start = begin[text] + CHUNK_STEP * (np.arange(first[-1]) - first[text])
    members = start[:, None] + np.arange(CHUNK_BLOCKS)
    members = np.where(members < begin[text + 1][:, None], members, begin[-1])
    return codes, members, first


def _forward(net: Network, codes: np.ndarray, members: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    n = (len(codes) - WIDTH) // HOP
    bytes_ = net["table"][codes]
    windows = np.ascontiguousarray(np.lib.stride_tricks.as_strided(
        bytes_, (n, WIDTH * DIM), (HOP * DIM * bytes_.itemsize, bytes_.itemsize)))
    seen = codes[:n * HOP:HOP] != PAD
    response = windows @ net["filters"]
    response += net["offset"]
    np.maximum(response, 0, out=response)
    response *= seen[:, None]
    grouped = response.reshape(-1, BLOCK // HOP, FILTERS)
    nothing = np.zeros((1, FILTERS), np.float32)
    top = np.concatenate([grouped.max(axis=1), nothing])
    mean = np.concatenate([grouped.mean(axis=1), nothing])
    high, low = top[members], mean[members]
    chunk = np.concatenate([high.max(axis=1), low.mean(axis=1) * 4], axis=1)
    judged = np.maximum(chunk @ net["hidden"] + net["shift"], 0)
    counts = np.diff(first)[:, None]
    pooled = np.concatenate([np.add.reduceat(judged, first[:-1]) / counts, np.maximum.reduceat(judged, first[:-1])], axis=1)
    score = pooled @ net["last"] + net["bias"][0]
    return {"windows": windows, "response": response, "grouped": grouped, "top": top, "high": high, "chunk": chunk, "judged": judged, "pooled": pooled, "score": score}


def _gradient(net: Network, x: dict[str, np.ndarray], codes: np.ndarray, members: np.ndarray, first: np.ndarray, label: np.ndarray) -> Network:
    p = 1 / (1 + np.exp(-x["score"]))
    out: Network = {}
    d = ((p - label) / len(label)).astype(np.float32)
    out["bias"], out["last"] = d.sum(keepdims=True), x["pooled"].T @ d
    pooled = d[:, None] * net["last"]
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    judged = (pooled[:, :HIDDEN] / counts[:, None])[text]
    judged += np.where(x["judged"] == x["pooled"][:, HIDDEN:][text], pooled[:, HIDDEN:][text], 0)
    judged *= x["judged"] > 0
    out["hidden"], out["shift"] = x["chunk"].T @ judged, judged.sum(axis=0)
    chunk = judged @ net["hidden"].T
    top, mean = np.zeros_like(x["top"]), np.zeros_like(x["top"])
    best = x["high"].argmax(axis=1)
    lanes = np.arange(FILTERS)
    np.add.at(top, (np.take_along_axis(members, best, axis=1), lanes[None, :]), chunk[:, :FILTERS])
    np.add.at(mean, members.reshape(-1), np.repeat(chunk[:, FILTERS:] * (4 / CHUNK_BLOCKS), CHUNK_BLOCKS, axis=0))
    response = np.repeat(mean[:-1, None, :] / (BLOCK // HOP), BLOCK // HOP, axis=1)
    at = x["grouped"].argmax(axis=1)
    response[np.arange(len(at))[:, None], at, lanes[None, :]] += top[:-1]
    response = response.reshape(-1, FILTERS) * (x["response"] > 0)
    out["filters"], out["offset"] = x["windows"].T @ response, response.sum(axis=0)
    windows = response @ net["filters"].T
    bytes_ = np.zeros((len(codes), DIM), np.float32)
    for t in range(WIDTH):
        bytes_[t:t + HOP * len(windows):HOP] += windows[:, t * DIM:(t + 1) * DIM]
    out["table"] = np.stack([np.bincount(codes, bytes_[:, k], PAD + 1) for k in range(DIM)], axis=1).astype(np.float32)
    out["table"][PAD] = 0
    return out


def fit(texts: list[bytes], labels: list[int], steps: int = STEPS, seed: int = 7, batch: int = 48, rate: float = 0.004) -> Network:
    """About ``steps`` steps of Adam over the given sample, whatever its size; the last ones are averaged. Without texts, or with one class, the net stays near 0.5."""
    net, draw = fresh(seed), np.random.default_rng(seed)
    if not texts:
        return net
    label = np.array(labels, np.float32)
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    mean = {k: np.zeros_like(v) for k, v in net.items()}
    epochs = -(-steps // -(-len(texts) // batch))
    step, steps, kept = 0, epochs * -(-len(texts) // batch), 0
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for low in range(0, len(order), batch):
            some = order[low:low + batch]
            at = np.concatenate([[0], np.cumsum([len(texts[i]) for i in some])])
            laid = _layout(np.frombuffer(b"".join(texts[i] for i in some), np.uint8), at)
            grad = _gradient(net, _forward(net, *laid), *laid, label[some])
            step += 1
            pace = rate * (1 - step / (steps + 1))
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net[k] = (net[k] - pace * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
            if step > 0.8 * steps:
                kept += 1
                for k in net:
                    mean[k] += net[k]
    return {k: (v / kept).astype(np.float32) for k, v in mean.items()} if kept else net


def scores(net: Network, texts: pa.Array, limit: int = 1 << 18) -> np.ndarray:
    """A probability for every text, null and empty ones included, each from all its bytes."""
    data, at = buffers(texts)
    out = np.zeros(len(at) - 1)
    for rows in slices(at, limit):
        span = at[rows.start:rows.stop + 1]
        if span[-1] - span[0] <= 4 * limit:
            out[rows] = _forward(net, *_layout(data, span))["score"]
        else:
            out[rows.start] = _long(net, data[span[0]:span[1]], limit)
    return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def _long(net: Network, data: np.ndarray, limit: int) -> float:
    """One very long text piece by piece in bounded memory: its chunks are those it has in one piece."""
    stride = BLOCK * CHUNK_STEP * max(1, limit // (BLOCK * CHUNK_STEP))
    total, top, chunks = 0.0, np.zeros(HIDDEN), 0
    blocks = -(-(len(data) + WIDTH) // BLOCK)
    for low in range(0, max(1, (blocks - 1) * BLOCK), stride):
        piece = data[low:low + stride + BLOCK + WIDTH]
        codes, members, first = _layout(piece, np.array([0, len(piece)]))
        n = min(stride // (BLOCK * CHUNK_STEP), max(1, -(-(blocks - 1 - low // BLOCK) // CHUNK_STEP)))
        judged = _forward(net, codes, members[:n], np.array([0, n]))["judged"]
        total, top, chunks = total + judged.sum(axis=0), np.maximum(top, judged.max(axis=0)), chunks + n
    return float(np.concatenate([total / chunks, top]) @ net["last"] + net["bias"][0])


def sections(text: Column, doc_id: Column) -> Column:
    """The bytes of a short text; of a longer one, a chunk from each of ``SECTIONS`` equal parts, at places drawn from the id."""
    data, chunk, size = text.cast("binary"), CHUNK_BLOCKS * BLOCK, F.octet_length(text)
    part = F.floor(size / SECTIONS).cast("int")
    place = lambda k: 1 + part * k + F.pmod(F.xxhash64(doc_id, F.lit(k)), part - chunk + 1).cast("int")
    return F.when(size <= SECTIONS * chunk, data).otherwise(F.concat(*[F.substring(data, place(k), F.lit(chunk)) for k in range(SECTIONS)]))


def sample(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[bytes], list[int]]:
    """At most ``rows`` labelled texts of ``documents(doc_id, text)`` by ``labels(doc_id, quality)``; bounded in rows and bytes.

    Rows without an id or label are left out; an id with several labels takes their majority, ties count as 1.
    """
    named = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    named = named.withColumn("h", F.xxhash64("doc_id"))
    chosen = [named.where(F.col("label") == k).orderBy("h", "doc_id").limit(rows // 2) for k in (0, 1)]
    # at most ``rows`` ids, so their broadcast is bounded
    got = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    # of several texts of one id the lowest by its hash
    one = got.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), sections(F.col("text"), F.col("doc_id")).alias("data"))).alias("t"))
    found = one.select("label", "t.data", F.xxhash64("doc_id").alias("h"), "doc_id").orderBy("h", "doc_id").collect()
    return [bytes(r["data"]) for r in found], [r["label"] for r in found]


def scorer(net: Network):
    """The fitted network as a function of a text column."""

    @F.arrow_udf("double")
    def quality_score(text: pa.Array) -> pa.Array:
        return pa.array(scores(net, text))

    return quality_score


def trained_on(doc_id: Column) -> Column:
    """Rows whose labels may be learned: crc32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def fit_quality(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network:
    return fit(*sample(documents, labels.where(trained_on(F.col("doc_id"))), rows))


def score_documents(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``documents``; null and empty texts have a score too."""
    score = scorer(fit_quality(documents, labels, rows))
    held = ~trained_on(F.col("doc_id")) & F.col("doc_id").isNotNull()
    scored = documents.select("doc_id", held.alias("held_out"), score(F.col("text")).alias("score"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
