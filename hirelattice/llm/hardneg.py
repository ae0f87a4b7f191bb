"""Hard negatives by an STR-packed R-tree over inner products.

Rows ``(vec_id, label, q)`` with integer components are packed into tiles by sorting on the label and then on the
coordinates of largest spread (sort-tile-recursive). The cuts are fitted on ``SAMPLE`` rows drawn by a hash, all
rows are put into tiles by them, and a tile is dealt by a hash into pages of bounded size. Boxes of tiles, the upper
nodes of the tree, are at most ``TILES``; each page is packed again into leaves and inner nodes inside its task.

The bound of a box on an anchor's inner product is, coordinate by coordinate, the larger (or smaller) of the
products with the box' two ends. An anchor visits only tiles, and there only nodes, whose labels fit, whose interval
meets one of its score windows and whose upper bound isn't strictly below the k-th best score known. A first k-th
best comes from the sample, whose rows are rows of the table, so it is a true lower bound and the answer is exact:
nothing is approximate and no candidate is cut off. Nodes come off a queue, best bound first.

Pages and the anchors that visit them meet in a cogroup of bounded size: pages hold ``page_rows`` rows, and anchors are
dealt into parts of about ``PART``. Vectors spread evenly over all directions have boxes that bound little; then
all tiles are visited, and the work is that of the comparison of all anchors with all rows.

Rows with a null id or label, a null vector, or a null or non-finite component take no part. Of rows that repeat
an id the one with the least (label, vector) does. Vectors of unequal lengths have no score. Scores are exact 64-bit
integers (a score beyond that is an error). An empty table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hirelattice.llm.common import stored

# rows that tiles are fitted on at most, and their bytes
SAMPLE, SAMPLE_BYTES = 8192, 8 << 20
# boxes held by every task
TILES = 1024
# anchors that meet a page at once, about
PART = 4096
LEAF, FANOUT = 32, 16
# leaves taken off the queue at once
STEP = 8


def prepared(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, q) of the rows of ``rows(vec_id, label, embedding)`` that take part; q is floor(scale * x)."""
    x = F.col("embedding").cast("array<double>")
    ok = F.forall(x, lambda v: F.coalesce((F.abs(v) != float("inf")) & ~F.isnan(v), F.lit(False)))
    q = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    fit = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(ok)
    fit = fit.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), q.alias("q"))
    return fit.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows: float64 where every inner product is exact in it, else Python integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if dim else np.zeros((len(column), 0), np.int64)
    top = max(abs(int(flat.max(initial=0))), abs(int(flat.min(initial=0))))
    return flat.astype(np.float64) if top * top * max(1, flat.shape[1]) < 1 << 52 else flat.astype(object)


def _same(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as floats if their inner products are exact so, or both as Python integers."""
    if object not in (a.dtype, b.dtype):
        top = max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) * max(1, a.shape[-1])
        if top < 1 << 52:
            return a, b
    whole = np.frompyfunc(int, 1, 1)
    return whole(a).astype(object), whole(b).astype(object)


def _ranked(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Higher scores first, then smaller ids."""
    if scores.dtype != object:
        return np.lexsort((ids, -scores))
    return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), dtype=np.int64)


class Boxes:
    """Bounding boxes with label ranges."""

    def __init__(self, low: np.ndarray, high: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.low, self.high, self.first, self.last = low, high, first, last

    def bounds(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each row of ``a`` with each box."""
        a, low = _same(a, self.low)
        a, high = _same(a, self.high)
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        return up @ low.T + down @ high.T, up @ high.T + down @ low.T

    def fits(self, label: int, same: bool) -> np.ndarray:
        """Boxes that may hold rows of that label, or of any other."""
        return (self.first <= label) & (label <= self.last) if same else (self.first != label) | (self.last != label)


def _spread(q: np.ndarray) -> np.ndarray:
    """Coordinates, that of the largest range of values first."""
    return np.argsort(-(q.max(axis=0) - q.min(axis=0)).astype(float), kind="stable") if len(q) else np.arange(0)


class Cuts:
    """The tiles of a sample: cuts on the label, then on one coordinate after the other."""

    def __init__(self, label: np.ndarray, q: np.ndarray, tiles: int):
        self.tiles = 0
        self.root = self._fit(label, q, tiles, None)

    def _fit(self, label, q, tiles: int, axes):
        if tiles <= 1 or len(label) < 2 or (axes is not None and not len(axes)):
            self.tiles += 1
            return self.tiles - 1
        if axes is None:
            # labels with a tile's share of the rows get slabs of their own
            values = np.sort(label)
            cut = np.unique(values[(np.arange(1, tiles) * len(values)) // tiles])
            cut = np.unique(np.concatenate([cut, [v + 1 for v in cut.tolist()]]))
            key, rest, at = label, _spread(q)[:3], -1
        else:
            slabs = int(np.ceil(tiles ** (1 / len(axes))))
            values = np.sort(q[:, axes[0]])
            cut = np.unique(values[(np.arange(1, slabs) * len(values)) // slabs])
            key, rest, at = q[:, axes[0]], axes[1:], int(axes[0])
        of = np.searchsorted(cut, key, "right")
        parts = []
        for k in range(len(cut) + 1):
            own = of == k
            parts.append(self._fit(label[own], q[own], round(tiles * own.sum() / len(label)), rest))
        return at, cut, parts

    def assign(self, label: np.ndarray, q: np.ndarray) -> np.ndarray:
        out = np.zeros(len(label), np.int64)

        def walk(node, rows):
            if isinstance(node, int):
                out[rows] = node
            elif len(rows):
                at, cut, parts = node
                of = np.searchsorted(cut, label[rows] if at < 0 else q[rows, at], "right")
                for k, part in enumerate(parts):
                    walk(part, rows[of == k])

        walk(self.root, np.arange(len(label)))
        return out


class Tree:
    """An STR-packed R-tree of one page; level 0 holds the leaves."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, q: np.ndarray):
        order = np.lexsort((ids, label))
        q, label, ids = q[order], label[order], ids[order]
        order = np.concatenate([start + self._pack(q[start:stop], list(_spread(q[start:stop])[:3])) for start, stop in self._runs(label)])
        self.ids, self.label, self.q = ids[order], label[order], q[order]
        edge = np.append(np.arange(0, len(ids), LEAF), len(ids))
        first, last = edge[:-1], edge[1:]
        low, high, l0, l1 = [], [], [], []
        self.children: list[tuple[int, int]] = []
        nodes = [(int(a), int(b)) for a, b in zip(first, last)]
        for a, b in nodes:
            low.append(self.q[a:b].min(axis=0)), high.append(self.q[a:b].max(axis=0))
            l0.append(self.label[a:b].min()), l1.append(self.label[a:b].max())
        self.leaves, self.spans = len(nodes), nodes
        begin, count = 0, len(nodes)
        while count > 1:
            for a in range(begin, begin + count, FANOUT):
                b = min(a + FANOUT, begin + count)
                self.children.append((a, b))
                low.append(np.min(low[a:b], axis=0)), high.append(np.max(high[a:b], axis=0))
                l0.append(min(l0[a:b])), l1.append(max(l1[a:b]))
            begin, count = begin + count, -(-count // FANOUT)
        self.boxes = Boxes(np.stack(low), np.stack(high), np.array(l0), np.array(l1))

    @staticmethod
    def _runs(label: np.ndarray) -> list[tuple[int, int]]:
        edge = [0, *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist(), len(label)]
        return list(zip(edge[:-1], edge[1:]))

    @classmethod
    def _pack(cls, q: np.ndarray, axes: list[int]) -> np.ndarray:
        """The order of rows in which every ``LEAF`` of them make a leaf."""
        leaves = -(-len(q) // LEAF)
        if leaves <= 1 or not axes:
            return np.arange(len(q))
        order = np.argsort(q[:, axes[0]], kind="stable")
        slab = LEAF * -(-leaves // int(np.ceil(leaves ** (1 / len(axes)))))
        return np.concatenate([part[cls._pack(q[part], axes[1:])] for part in np.split(order, range(slab, len(q), slab))])

    def search(self, anchor: np.ndarray, skip: int, label: int, same: bool, windows: list[tuple[int, int]], floors: list,
               k: int, low: np.ndarray, high: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each score window the ids and scores of the ``k`` best rows: label equal or different, id not ``skip``,
        score inside the window and not below its floor. ``low`` and ``high`` bound the scores of each node."""
        fits = self.boxes.fits(label, same)
        best = [(np.zeros(0, np.int64), np.zeros(0, self.q.dtype))] * len(windows)
        floors = list(floors)

        def wanted(node: int) -> bool:
            return fits[node] and any(high[node] >= max(lo, floor) and low[node] <= hi for (lo, hi), floor in zip(windows, floors))

        root = len(low) - 1
        queue = [(-high[root], root)] if root >= 0 and wanted(root) else []
        while queue:
            taken = []
            while queue and len(taken) < STEP:
                node = heapq.heappop(queue)[1]
                if not wanted(node):
                    continue
                if node < self.leaves:
                    taken.append(np.arange(*self.spans[node]))
                    continue
                for child in range(*self.children[node - self.leaves]):
                    if wanted(child):
                        heapq.heappush(queue, (-high[child], child))
            if not taken:
                break
            rows = np.concatenate(taken)
            rows = rows[((self.label[rows] == label) == same) & (self.ids[rows] != skip)]
            score = self.q[rows] @ anchor
            for w, (lo, hi) in enumerate(windows):
                inside = ((score >= max(lo, floors[w])) & (score <= hi)).astype(bool)
                if not inside.any():
                    continue
                ids = np.concatenate([best[w][0], self.ids[rows[inside]]])
                scores = np.concatenate([best[w][1], score[inside]])
                order = _ranked(ids, scores)[:k]
                best[w] = ids[order], scores[order]
                if len(order) == k:
                    floors[w] = max(floors[w], scores[order[-1]])
        return best


class Index:
    """What every task knows of the tree: the cuts, the boxes of the tiles with their pages, and the sample."""

    def __init__(self, dim: int, cuts: Cuts, sample: tuple):
        self.dim, self.cuts, self.sample = dim, cuts, sample
        self.boxes, self.tile, self.pages = None, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floors(self, score: np.ndarray, skip: int, label: int, same: bool, windows: list[tuple[int, int]], k: int) -> list[int]:
        """The k-th best score of the sample in each window: none of the k best rows of the table is below it."""
        ids, labels, _ = self.sample
        score = score[((labels == label) == same) & (ids != skip)]
        out = []
        for lo, hi in windows:
            inside = score[((score >= lo) & (score <= hi)).astype(bool)]
            out.append(int(np.sort(inside)[-k]) if len(inside) >= k else lo)
        return out


def _deal(index: Index):
    """Rows with their tile."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("q"), index.dim)
            tile = index.cuts.assign(batch.column("label").to_numpy(), q)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile)], [*batch.schema.names, "tile"])

    return deal


def build(rows: DataFrame, dim: int) -> tuple[DataFrame, Index, int]:
    """All rows of one length with ``tile`` and ``page``, the index, and how many rows there are."""
    spark = rows.sparkSession
    count = rows.count()
    most = max(64, min(SAMPLE, SAMPLE_BYTES // (8 * max(1, dim))))
    share = 1.5 * most / max(1, count)
    drawn = rows if share >= 1 else rows.where(F.pmod(F.xxhash64("vec_id", F.lit(13)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = drawn.orderBy(F.xxhash64("vec_id", F.lit(13)), "vec_id").limit(most).toArrow()
    ids, label, q = sample["vec_id"].to_numpy(), sample["label"].to_numpy(), _matrix(sample["q"], dim)
    page_rows = min(max(count // 256, 1024), 32768)
    index = Index(dim, Cuts(label, q, min(TILES, -(-count // page_rows))), (ids, label, q))
    kind = "vec_id long, label long, q array<long>, tile long"
    dealt = stored(rows.select("vec_id", "label", "q").mapInArrow(_deal(index), kind), "tiles")
    # boxes: one row for each task and tile, then one for each tile
    ends = dealt.mapInArrow(_ends(dim), "tile long, n long, l0 long, l1 long, low array<long>, high array<long>")
    boxes = ends.groupBy("tile").applyInPandas(_merged, "tile long, n long, l0 long, l1 long, low array<long>, high array<long>")
    boxes = boxes.orderBy("tile").toArrow()
    index.tile = boxes["tile"].to_numpy()
    index.pages = np.maximum(1, -(-boxes["n"].to_numpy() // page_rows))
    index.boxes = Boxes(_matrix(boxes["low"], dim), _matrix(boxes["high"], dim), boxes["l0"].to_numpy(), boxes["l1"].to_numpy())
    pages = spark.createDataFrame(pd.DataFrame({"tile": index.tile, "pages": index.pages}), "tile long, pages long")
    paged = dealt.join(F.broadcast(pages), "tile").withColumn("page", F.pmod(F.xxhash64("vec_id", F.lit(29)), F.col("pages"))).drop("pages")
    return paged, index, count


def _ends(dim: int):
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, list] = {}
        for batch in batches:
            tile, label = batch.column("tile").to_numpy(), batch.column("label").to_numpy()
            q = _matrix(batch.column("q"), dim)
            for t in np.unique(tile).tolist():
                own = tile == t
                new = [own.sum(), label[own].min(), label[own].max(), q[own].min(axis=0), q[own].max(axis=0)]
                old = have.get(t)
                have[t] = new if old is None else [
                    old[0] + new[0], min(old[1], new[1]), max(old[2], new[2]), np.minimum(old[3], new[3]), np.maximum(old[4], new[4])]
        if have:
            part = list(have.values())
            vectors = [pa.array([[int(x) for x in p[i]] for p in part], pa.list_(pa.int64())) for i in (3, 4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(have), pa.int64()), *(pa.array([int(p[i]) for p in part], pa.int64()) for i in range(3)), *vectors],
                ["tile", "n", "l0", "l1", "low", "high"])

    return ends


def _merged(part: pd.DataFrame) -> pd.DataFrame:
    low, high = np.min(np.stack(part["low"]), axis=0), np.max(np.stack(part["high"]), axis=0)
    return pd.DataFrame({"tile": part["tile"].iloc[:1], "n": part["n"].sum(), "l0": part["l0"].min(), "l1": part["l1"].max(),
                         "low": [low], "high": [high]})


_VISIT = "vec_id long, label long, q array<long>, lows array<long>, highs array<long>, names array<long>, floors array<long>, tile long, page long"
FAR = (1 << 62)


def _visits(index: Index, same: bool, k: int):
    """Anchors ``(vec_id, label, q, lows, highs, names)`` with their floors, once for each page of a tile that they visit."""

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a = _matrix(batch.column("q"), index.dim)
            low, high = index.boxes.bounds(a)
            a, sample = _same(a, index.sample[2])
            take, floors, tiles, pages = [], [], [], []
            for i, row in enumerate(batch.select(["vec_id", "label", "lows", "highs"]).to_pylist()):
                windows = list(zip(row["lows"], row["highs"]))
                floor = index.floors(sample @ a[i], row["vec_id"], row["label"], same, windows, k)
                fits = index.boxes.fits(row["label"], same)
                meets = np.zeros(len(fits), bool)
                for (lo, hi), f in zip(windows, floor):
                    meets |= ((high[i] >= max(lo, f)) & (low[i] <= hi)).astype(bool)
                for t in np.flatnonzero(fits & meets).tolist():
                    for page in range(int(index.pages[t])):
                        take.append(i), floors.append(floor), tiles.append(int(index.tile[t])), pages.append(page)
            if take:
                at = pa.array(take, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in ("vec_id", "label", "q", "lows", "highs", "names")),
                     pa.array(floors, pa.list_(pa.int64())), pa.array(tiles, pa.int64()), pa.array(pages, pa.int64())],
                    ["vec_id", "label", "q", "lows", "highs", "names", "floors", "tile", "page"])

    return visits


def _meet(dim: int, same: bool, k: int):
    """The best rows of one page for the anchors that visit it."""

    def meet(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"vec_id": [], "name": [], "id": [], "score": []}
        if len(anchors) and len(rows):
            tree = Tree(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["q"], dim))
            a = _matrix(anchors["q"], dim)
            low, high = tree.boxes.bounds(a)
            a, tree.q = _same(a, tree.q)
            for i, row in enumerate(anchors.select(["vec_id", "label", "lows", "highs", "names", "floors"]).to_pylist()):
                windows = list(zip(row["lows"], row["highs"]))
                found = tree.search(a[i], row["vec_id"], row["label"], same, windows, row["floors"], k, low[i], high[i])
                for name, (ids, scores) in zip(row["names"], found):
                    out["vec_id"] += [row["vec_id"]] * len(ids)
                    out["name"] += [name] * len(ids)
                    out["id"] += ids.tolist()
                    out["score"] += [int(s) for s in scores]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return meet


def best_in_windows(anchors: DataFrame, paged: DataFrame, index: Index, parts: int, same: bool, k: int) -> DataFrame:
    """``(vec_id, name, id, score, rank)``: for each anchor and window the ``k`` best rows, smaller ids first among ties.

    ``anchors(vec_id, label, q, lows, highs, names)`` holds the windows, their names among it.
    """
    part = F.pmod(F.xxhash64("vec_id", F.lit(31)), F.lit(parts)).alias("part")
    visits = anchors.mapInArrow(_visits(index, same, k), _VISIT).select("*", part)
    rows = paged.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
    keys = ["tile", "page", "part"]
    found = visits.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(_meet(index.dim, same, k), "vec_id long, name long, id long, score long")
    order = Window.partitionBy("vec_id", "name").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
                   scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``, positives their first ``positives`` other rows of the same
    label, negatives the first ``negatives`` rows of other labels with a score of ``least`` to ``most`` hundredths of the positive's.
    """
    base = stored(prepared(rows, scale), "vectors")
    out = rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    # lengths of vectors: one, unless the table mixes models
    for (dim,) in base.where(F.col("vec_id") % every == 0).select(F.size("q")).distinct().collect():
        own = base.where(F.size("q") == dim)
        paged, index, count = build(own, dim)
        anchors = own.where(F.col("vec_id") % every == 0).select("vec_id", "label", "q")
        parts = max(1, -(-anchors.count() // PART))
        one = lambda v: F.array(F.lit(v).cast("long"))
        open_ = anchors.select("*", one(-FAR).alias("lows"), one(FAR).alias("highs"), one(0).alias("names"))
        good = stored(best_in_windows(open_, paged, index, parts, True, positives), "positives")
        # least and greatest score inside, in decimals
        window = F.struct(
            F.col("id").alias("name"), F.expr(f"cast(ceil(cast(score as decimal(20, 0)) * {least} / 100) as bigint)").alias("low"),
            F.expr(f"cast(floor(cast(score as decimal(20, 0)) * {most} / 100) as bigint)").alias("high"))
        windows = good.groupBy("vec_id").agg(F.sort_array(F.collect_list(window)).alias("w")).select(
            "vec_id", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"), F.col("w.name").alias("names"))
        asked = stored(anchors.join(windows, "vec_id").select("vec_id", "label", "q", "lows", "highs", "names"), "asked")
        bad = best_in_windows(asked, paged, index, parts, False, negatives)
        score = good.select("vec_id", F.col("id").alias("name"), F.col("score").alias("positive_score"))
        out = out.union(bad.join(score, ["vec_id", "name"]).select(
            F.col("vec_id").alias("anchor_id"), F.col("name").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")))
    return out
