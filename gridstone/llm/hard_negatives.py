"""Hard negatives: for every anchor and each of its nearest positives, the nearest rows of another label
whose score lies in a window below the positive's.

Vectors are cut to integers, so scores are exact. The rows are packed by sort-tile-recursive order: sorted
and cut into slabs by label, then within each slab by the coordinate that varies most, and so on. Spark
deals the rows into tiles by cuts fitted on a bounded sample, writes them in tile order, and every page of
at most PAGE rows is packed exactly into an R-tree with leaves of LEAF rows. A box of an R-tree bounds every
coordinate, and so the inner product with an anchor: the sum of ``max(a*low, a*high)`` is the most, that of
``min`` the least a row inside can score; its range of labels tells whether it can hold the label sought.
A best-first queue takes boxes by what they can score at most and drops those outside all score windows, or
strictly below the k-th score found. What a task has found bounds its later pages.

Anchors go to the tasks in blocks of bounded size; each block takes one pass for the positives and one for
the negatives, and its result is written before the next block is sent. The rows stay where they are. A
task returns at most k rows for each anchor (and positive), ranked afterwards, so no group holds more than
k rows a task. Copies of one vector are ordinary rows of many pages.

Rows without id, label or vector, or with a null or non-finite component take no part. Only rows of the
anchor's vector length are compared with it. A repeated anchor id is searched once, with its smallest label
and vector; rows with the anchor's id are none of its partners; other repeated rows are partners each. Ties
go to the smaller id. Empty tables give an empty result; other columns are left out. Labels are integers.
Scores that might exceed 64 bits raise a ValueError. Runs jobs when called."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstone.llm.common import sent, written

PAGE, LEAF, FAN = 4096, 64, 8
#: Numbers in the sample that fits the tiles, and in a block of anchors.
SAMPLE_NUMBERS, BLOCK_NUMBERS = 1 << 20, 1 << 19
#: Sampled rows that give each anchor a first bound.
SEEDS = 1024


def _by_spread(label: np.ndarray, vectors: np.ndarray, n: int) -> np.ndarray:
    """The label, then the coordinates that vary most: as many as n tiles are cut by."""
    axes = max(1, n).bit_length() - 1
    order = np.argsort(-vectors.std(axis=0), kind="stable")[: max(0, axes - 1)] if len(vectors) else []
    return np.column_stack([label, vectors[:, order]])


class Tiles:
    """Nested cuts of the space, from a sample."""

    def __init__(self, label: np.ndarray, vectors: np.ndarray, n: int):
        self.order = np.argsort(-vectors.std(axis=0), kind="stable")[: max(0, max(1, n).bit_length() - 2)]
        self.n = 0
        self.root = self._cut(self._points(label, vectors), 0, n)

    def _points(self, label: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        return np.column_stack([label, vectors[:, self.order]])

    def _cut(self, points: np.ndarray, axis: int, n: int):
        if n <= 1 or axis == points.shape[1] or len(points) < 2:
            self.n += 1
            return self.n - 1
        slabs = int(np.ceil(n ** (1 / (points.shape[1] - axis))))
        cuts = np.unique(np.quantile(points[:, axis], np.arange(1, slabs) / slabs, method="lower"))
        part = np.searchsorted(cuts, points[:, axis])
        return axis, cuts, [self._cut(points[part == k], axis + 1, -(-n // slabs)) for k in range(len(cuts) + 1)]

    def of(self, label: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        points = self._points(label, vectors)
        tile = np.zeros(len(points), np.int64)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if isinstance(node, int):
                tile[rows] = node
                continue
            axis, cuts, children = node
            part = np.searchsorted(cuts, points[rows, axis])
            stack += [(child, rows[part == k]) for k, child in enumerate(children)]
        return tile


def packed(label: np.ndarray, vectors: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in sort-tile-recursive order, and where each leaf begins."""
    points = _by_spread(label, vectors, -(-len(label) // leaf))
    out: list[np.ndarray] = []

    def cut(rows: np.ndarray, axis: int) -> None:
        n = -(-len(rows) // leaf)
        if n <= 1:
            out.append(rows)
            return
        rows = rows[np.argsort(points[rows, axis], kind="stable")]
        left = points.shape[1] - axis
        slabs = int(np.ceil(n ** (1 / left)))
        size = leaf * -(-n // slabs)
        for i in range(0, len(rows), size):
            some = rows[i : i + size]
            if left > 1:
                cut(some, axis + 1)
            else:
                out.extend(some[j : j + leaf] for j in range(0, len(some), leaf))

    cut(np.arange(len(label)), 0)
    return np.concatenate(out), np.cumsum([0, *(len(x) for x in out)])


class RTree:
    """One page. Nodes are numbered from the leaves up; the last is the root."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, vectors: np.ndarray):
        order, self.begin = packed(label, vectors, LEAF)
        self.ids, self.label, self.vectors = ids[order], label[order], vectors[order]
        self.leaves = len(self.begin) - 1
        whole = np.column_stack([self.label, self.vectors])
        levels = [(np.minimum.reduceat(whole, self.begin[:-1]), np.maximum.reduceat(whole, self.begin[:-1]))]
        self.children: list[range] = [range(0)] * self.leaves
        first = 0
        while len(levels[-1][0]) > 1:
            low, high = levels[-1]
            at = np.arange(0, len(low), FAN)
            self.children += [range(first + i, first + min(i + FAN, len(low))) for i in at.tolist()]
            first += len(low)
            levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
        low, high = (np.concatenate(x) for x in zip(*levels, strict=True))
        self.low, self.high = low[:, 1:], high[:, 1:]
        self.labels = low[:, 0].astype(np.int64), high[:, 0].astype(np.int64)

    def scores_of(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the most that each box can score with each anchor."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def search(self, anchor: np.ndarray, least: np.ndarray, most: np.ndarray, wanted: np.ndarray, useful: Callable[[float, float], bool], visit: Callable[[slice, np.ndarray], None]) -> None:
        """Visits leaves best first, as long as ``useful(least, most)`` says that a box may help."""
        queue = [(-most[root], root) for root in [len(most) - 1] if wanted[root]]
        heapify(queue)
        while queue:
            top, node = heappop(queue)
            if not useful(least[node], -top):
                continue
            if node < self.leaves:
                rows = slice(self.begin[node], self.begin[node + 1])
                visit(rows, self.vectors[rows] @ anchor)
            else:
                for child in self.children[node]:
                    if wanted[child]:
                        heappush(queue, (-most[child], child))


class Best:
    """The k best (score, id) so far, larger scores first, then smaller ids."""

    __slots__ = ("k", "score", "id", "bound")

    def __init__(self, k: int, bound: float):
        self.k, self.bound = k, bound  # no score below the bound is of use
        self.score, self.id = None, None

    def __iter__(self) -> Iterator[tuple[int, int]]:
        return iter(()) if self.id is None else ((int(x), int(s)) for x, s in zip(self.id, self.score, strict=True))

    def take(self, score: np.ndarray, ids: np.ndarray) -> None:
        some = score >= self.bound
        if not some.any():
            return
        score, ids = score[some], ids[some]
        if self.id is not None:
            score, ids = np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.id = score[order], ids[order]
        if len(order) == self.k:
            self.bound = max(self.bound, self.score[-1])


class Block:
    """Anchors that travel together, by vector length: ids, labels, vectors, and what bounds their search."""

    def __init__(self, anchors: pa.Table, kind: type):
        self.kind = kind
        self.groups = {n: rows for n, rows in _by_length(anchors, kind)}
        self.bounds: dict[int, float] = {}
        self.positives: dict[int, list[tuple[int, int, int]]] = {}  # anchor: (turn, id, score)


def _by_length(rows: pa.Table | pa.RecordBatch, kind: type) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(id, label, vectors) of the rows of each vector length."""
    sizes = pc.list_value_length(rows.column("v")).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else np.asarray(pc.list_value_length(rows.column("v")))
    for n in np.unique(sizes).tolist():
        some = rows.take(pa.array(np.flatnonzero(sizes == n)))
        v = some.column("v")
        flat = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        vectors = np.asarray(flat.flatten()).astype(kind).reshape(len(some), n)
        yield n, (np.asarray(some.column("id")), np.asarray(some.column("label")), vectors)


def _pages(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[int, RTree]]:
    for batch in batches:
        for i in range(0, len(batch), PAGE):
            for n, rows in _by_length(batch.slice(i, PAGE), kind):
                yield n, RTree(*rows)


def _positives(block: Block, pages: Iterator[tuple[int, RTree]], k: int) -> Iterator[tuple[int, int, int]]:
    found: dict[int, Best] = {}
    for n, tree in pages:
        if n not in block.groups:
            continue
        ids, labels, vectors = block.groups[n]
        least, most = tree.scores_of(vectors)
        for i, (anchor, label) in enumerate(zip(ids.tolist(), labels.tolist(), strict=True)):
            best = found.setdefault(anchor, Best(k, block.bounds.get(anchor, -np.inf)))
            wanted = (tree.labels[0] <= label) & (label <= tree.labels[1])

            def visit(rows: slice, score: np.ndarray, best=best, anchor=anchor, label=label, tree=tree) -> None:
                some = (tree.label[rows] == label) & (tree.ids[rows] != anchor)
                best.take(score[some], tree.ids[rows][some])

            tree.search(vectors[i], least[i], most[i], wanted, lambda low, high, best=best: high >= best.bound, visit)
    for anchor, best in found.items():
        yield from ((anchor, x, s) for x, s in best)


def _negatives(block: Block, pages: Iterator[tuple[int, RTree]], k: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """low, high: percent of the positive's score."""
    found: dict[int, list[tuple[int, Best]]] = {}
    for n, tree in pages:
        if n not in block.groups:
            continue
        ids, labels, vectors = block.groups[n]
        least, most = tree.scores_of(vectors)
        for i, (anchor, label) in enumerate(zip(ids.tolist(), labels.tolist(), strict=True)):
            if anchor not in block.positives:
                continue
            # Integer scores s with low*p <= 100*s <= high*p: at least -(-low*p // 100), at most high*p // 100.
            own = found.setdefault(anchor, [(high * p // 100, Best(k, -(-low * p // 100))) for _, _, p in block.positives[anchor]])
            wanted = (tree.labels[0] != label) | (tree.labels[1] != label)

            def useful(lowest: float, highest: float, own=own) -> bool:
                return any(lowest <= top and highest >= best.bound for top, best in own)

            def visit(rows: slice, score: np.ndarray, own=own, anchor=anchor, label=label, tree=tree) -> None:
                some = (tree.label[rows] != label) & (tree.ids[rows] != anchor)
                score, names = score[some], tree.ids[rows][some]
                for top, best in own:
                    within = score <= top
                    best.take(score[within], names[within])

            tree.search(vectors[i], least[i], most[i], wanted, useful, visit)
    for anchor, own in found.items():
        for (turn, positive, p), (_, best) in zip(block.positives[anchor], own, strict=True):
            yield from ((anchor, turn, positive, p, x, s) for x, s in best)


def _seeded(block: Block, sample: pa.Table, k: int) -> None:
    """Sampled rows are rows too: the k-th best of them bounds each anchor's k-th positive from below."""
    for n, rows in _by_length(sample.slice(0, SEEDS), block.kind):
        if n in block.groups:
            ids, labels, vectors = block.groups[n]
            score = vectors @ rows[2].T
            for i, anchor in enumerate(ids.tolist()):
                some = np.sort(score[i][(rows[1] == labels[i]) & (rows[0] != anchor)])
                if len(some) >= k:
                    block.bounds[anchor] = some[-k]


def mine(embeddings: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label", n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: up to ``n_negatives``
    rows of another label for each of the ``n_positives`` best rows of the anchor's own label, with a
    score from ``low`` to ``high`` percent of the positive's. ``scale``: components become floor(scale * x)."""
    spark = embeddings.sparkSession
    wide = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(
        F.col(key).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.when(usable, F.transform(wide, lambda x: F.floor(x * scale))).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).where("id is not null and label is not null and v is not null")
    widest = F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))), F.lit(0.0))
    seen = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("length"), F.max(widest).alias("widest"), F.max(F.abs(F.col("label").cast("double"))).alias("label")).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not seen.n:
        return spark.createDataFrame([], result)
    largest = max(1, seen.length) * max(seen.widest, 1.0) ** 2
    if largest >= 2.0**63:
        raise ValueError("scores of these vectors exceed 64 bits")
    kind = np.float64 if max(largest, seen.label) < 2.0**53 else np.int64  # both add integers exactly

    sampled = max(1, SAMPLE_NUMBERS // max(1, seen.length))
    sample = rows.sample(min(1.0, sampled / seen.n), seed=5).limit(2 * sampled).select("id", "label", "v").toArrow()
    shares = {n: len(x[0]) / len(sample) for n, x in _by_length(sample, kind)}
    tiles = {n: Tiles(x[1], x[2], -(-int(shares[n] * seen.n) // PAGE)) for n, x in _by_length(sample, kind)}
    there = sent(spark, tiles)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = there()
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            tile = np.zeros(len(batch), np.int64)
            for n, (_, own, vectors) in _by_length(batch, kind):
                if n in tiles:
                    tile[sizes == n] = tiles[n].of(own, vectors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile)], [*batch.schema.names, "tile"])

    tiled = rows.mapInArrow(placed, "id long, label long, v array<long>, anchor boolean, tile long")
    order = [F.size("v"), F.col("tile"), F.xxhash64("id", "v")]
    data = written(tiled.repartitionByRange(*order).sortWithinPartitions(*order).drop("tile"), "negatives_tiles")
    asked = written(data.where("anchor").groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.*"), "negatives_anchors")
    blocks = max(1, -(-asked.count() * max(1, seen.length) // BLOCK_NUMBERS))

    def searched(block: Block, search: Callable, names: str) -> DataFrame:
        shared = sent(spark, block)
        columns = [c.split()[0] for c in names.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared()
            found = np.array([*search(block, _pages(batches, block.kind))], np.int64).reshape(-1, len(columns))
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in found.T], columns)

        return data.select("id", "label", "v").mapInArrow(run, names)

    parts = []
    for b in range(blocks):
        block = Block(asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow(), kind)
        _seeded(block, sample, n_positives)
        best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
        near = searched(block, lambda *x: _positives(*x, n_positives), "anchor_id long, id long, score long")
        for r in near.withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= n_positives).orderBy("anchor_id", "turn").collect():
            block.positives.setdefault(r.anchor_id, []).append((r.turn, r.id, r.score))
        best = Window.partitionBy("anchor_id", "turn").orderBy(F.desc("negative_score"), "negative_id")
        names = "anchor_id long, turn long, positive_id long, positive_score long, negative_id long, negative_score long"
        far = searched(block, lambda *x: _negatives(*x, n_negatives, low, high), names)
        ranked = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
        parts.append(written(ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives_found"))
    return reduce(DataFrame.unionAll, parts)
