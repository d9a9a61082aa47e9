"""Nearest neighbours by inner product, through low-dimensional stable projections in kd-trees.

With a last coordinate that brings every vector to the largest norm, the largest inner product is the
smallest Euclidean distance. Gaussian projections to ``DIMENSIONS`` numbers are stable: the squared
projected distance of two vectors, over the squared true one, is chi-square distributed. So neighbours
are taken in order of projected distance and verified by their true inner product until

    projected distance^2  >  chi-square quantile  *  (true distance of the k-th best so far)^2,

beyond which a nearer vector is unlikely. The kd-tree has two levels. The upper one cuts the projected
space into cells, fitted on at most SAMPLE vectors; every vector is assigned to a cell, and cells are
dealt in parts of about CELL vectors, so a cell of many equal vectors is many tasks. Within a part a
tree of leaves of LEAF vectors orders the search. A query first searches its own cell; the bound found
there decides, by the same test, which other cells it visits.

Vectors of each length have an index of their own, as only they have inner products with each other.

Nulls: vectors that are null, zero, or hold null or non-finite numbers take no part, nor do rows without
an id. A repeated query id is searched once, with its smallest vector; repeated candidates are candidates
each; rows with the query's id are none. Ties go to the smaller id. With fewer than k candidates all are
found, empty tables give an empty result, other columns are ignored. Runs jobs when called."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstone.llm.common import sent, written

DIMENSIONS, SAMPLE, CELL, LEAF, QUERIES, PAIRS = 8, 20_000, 4096, 64, 4096, 1 << 16
_NORMAL = 2.326  # standard normal quantile of the stopping test, 0.99


def chi_square(n: int, normal: float = _NORMAL) -> float:
    """Quantile of the chi-square distribution, by the cube-root approximation."""
    return n * (1 - 2 / (9 * n) + normal * (2 / (9 * n)) ** 0.5) ** 3


class Tree:
    """Splits of the projected space into cells, and the bounds of the cells."""

    def __init__(self, points: np.ndarray, n_cells: int):
        self.splits: list[tuple[int, float, int, int]] = []
        self.low, self.high = [], []
        full = np.full(points.shape[1], np.inf)
        self.root = self._cut(points, max(1, n_cells), -full, full)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _cut(self, points, n, low, high) -> int:
        """A node: a cell as its negative number less one, or a split."""
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(len(low))
        axis = int(np.argmax(spread))
        if n <= 1 or len(points) < 32 or spread[axis] == 0:
            self.low.append(low)
            self.high.append(high)
            return -len(self.low)
        at = float(np.median(points[:, axis]))
        left = points[:, axis] <= at
        if left.all():
            left = points[:, axis] < at
            at = float(points[left, axis].max())
        me = len(self.splits)
        self.splits.append((axis, at, 0, 0))
        upper, lower = high.copy(), low.copy()
        upper[axis], lower[axis] = at, at
        self.splits[me] = (axis, at, self._cut(points[left], n // 2, low, upper), self._cut(points[~left], n - n // 2, lower, high))
        return me

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.full(len(points), self.root)
        while (inner := np.flatnonzero(node >= 0)).size:
            axis, at, left, right = (np.array(x)[node[inner]] for x in zip(*self.splits, strict=True))
            node[inner] = np.where(points[inner, axis] <= at, left, right)
        return -node - 1

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared distance of a point to every cell."""
        return (np.maximum(np.maximum(self.low - point, point - self.high), 0) ** 2).sum(axis=1)


class Index:
    def __init__(self, length: int, norm: float):
        self.length, self.norm = length, norm
        self.projection = np.random.default_rng(length).standard_normal((length + 1, DIMENSIONS))
        self.tree: Tree | None = None

    def vectors(self, column: pa.Array) -> np.ndarray:
        return np.asarray(column.values if column.offset == 0 else column.flatten(), float).reshape(-1, self.length)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest]) @ self.projection

    def project_queries(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors * (self.norm / np.sqrt((vectors**2).sum(axis=1, keepdims=True)))
        return np.column_stack([scaled, np.zeros(len(vectors))]) @ self.projection

    def radius(self, score: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Squared projected radius to search, given the k-th best score of queries of a norm."""
        return chi_square(DIMENSIONS) * np.maximum(2 * self.norm**2 - 2 * self.norm * score / size, 0) * (1 + 1e-9)


def usable(vector: Column) -> Column:
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite & F.exists(wide, lambda x: x != 0), wide)


def nearest(embeddings: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row that ``queries`` selects: query_id, rank, ``key`` and score of its k nearest."""
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(key).cast("long").alias("id"), usable(F.col(vector)).alias("v"), F.coalesce(queries, F.lit(False)).alias("q")).where("id is not null and v is not null")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    asked = rows.where("q").groupBy("id").agg(F.min("v").alias("v"))
    found = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    for r in rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"), F.max(norm).alias("norm"), F.count_if("q").alias("queries")).collect():
        if r.queries:
            alike = F.size("v") == r.length
            found = found.unionByName(_nearest(rows.where(alike).select("id", "v"), asked.where(alike), Index(r.length, r.norm), r.n, k))
    return found.withColumnRenamed("id", key)


def _nearest(rows: DataFrame, asked: DataFrame, index: Index, n: int, k: int) -> DataFrame:
    """The same for vectors of one length."""
    spark = rows.sparkSession
    step = max(1, n // SAMPLE)
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).select("v").limit(2 * SAMPLE).toArrow().column("v").combine_chunks()
    index.tree = Tree(index.project(index.vectors(some)), -(-n // CELL))
    there = sent(spark, index)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x: Index = there()
        for batch in batches:
            if len(batch):
                own = x.tree.cell(x.project(x.vectors(batch.column("v"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], ["id", "v", "cell"])

    data = written(rows.mapInArrow(placed, "id long, v array<double>, cell int"), "ann_cells")
    parts = written(data.groupBy("cell").agg(F.ceil(F.count("*") / CELL).alias("parts")), "ann_parts")

    def routed(bounded: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x: Index = there()
            for batch in batches:
                if not len(batch):
                    continue
                vectors = x.vectors(batch.column("v"))
                points = x.project_queries(vectors)
                home = x.tree.cell(points)
                if bounded:
                    bounds = batch.column("bound").to_numpy(zero_copy_only=False)
                    reach = np.where(np.isnan(bounds), np.inf, x.radius(np.nan_to_num(bounds), np.sqrt((vectors**2).sum(axis=1))))
                    cells = [np.setdiff1d(np.flatnonzero(x.tree.distances(p) <= r), [h]) for p, r, h in zip(points, reach, home, strict=True)]
                    at, cell = np.repeat(np.arange(len(cells)), [len(c) for c in cells]), np.concatenate(cells)
                else:
                    bounds, at, cell = np.full(len(batch), np.nan), np.arange(len(batch)), home
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), batch.column("v").take(pa.array(at)), pa.array(bounds[at]), pa.array(cell.astype(np.int32))], ["id", "v", "bound", "cell"])
        return run

    def searched(routes: DataFrame) -> DataFrame:
        """Queries meet the parts of a cell in chunks of about QUERIES; a part goes out once for each chunk of the queries that visit its cell."""
        visits = routes.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).alias("chunks")).join(parts, "cell")
        upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        dealt = routes.join(visits, "cell").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks")).withColumn("part", upto("parts"))
        held = data.join(visits, "cell").withColumn("part", F.pmod(F.xxhash64("id", "v"), "parts")).withColumn("chunk", upto("chunks"))

        def run(own: pa.Table, asking: pa.Table) -> pa.Table:
            x: Index = there()
            out = _search(x, own, asking, k) if len(own) and len(asking) else ([], [], [])
            return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "id", "score"])

        by = ("cell", "part", "chunk")
        grouped = held.select("id", "v", *by).groupBy(*by).cogroup(dealt.select("id", "v", "bound", *by).groupBy(*by))
        return grouped.applyInArrow(run, "query_id long, id long, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    route = "id long, v array<double>, bound double, cell int"
    first = written(searched(asked.mapInArrow(routed(False), route)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "ann_home")
    bounds = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    second = searched(asked.join(bounds, "id", "left").mapInArrow(routed(True), route))
    found = first.drop("rank").unionByName(second).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """Rows of a kd-tree's leaves, halved along the widest side."""
    out, stack = [], [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        axis = int(np.argmax(np.ptp(points[rows], axis=0)))
        order = rows[np.argpartition(points[rows, axis], len(rows) // 2)]
        stack += [order[: len(rows) // 2], order[len(rows) // 2 :]]
    return out


def _search(x: Index, own: pa.Table, asking: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best candidates of a part for each query, verified in order of projected distance.

    All queries advance together, each by its next leaves, twice as many every time; the queries at a
    leaf are verified by one matrix product, and what may be among the k best is scored anew row by row,
    so that equal vectors have equal scores."""
    ids, vectors = own.column("id").to_numpy(), x.vectors(own.column("v").combine_chunks())
    points = x.project(vectors)
    leaves = _leaves(points)
    order, sizes = np.concatenate(leaves), np.array([len(rows) for rows in leaves])
    ids, vectors, points = ids[order], vectors[order], points[order]
    begin = np.append(0, np.cumsum(sizes))
    low, high = np.minimum.reduceat(points, begin[:-1]), np.maximum.reduceat(points, begin[:-1])
    q_ids, q_vectors = asking.column("id").to_numpy(), x.vectors(asking.column("v").combine_chunks())
    bounds = np.nan_to_num(asking.column("bound").to_numpy(), nan=-np.inf)
    norms, q_points = np.sqrt((q_vectors**2).sum(axis=1)), x.project_queries(q_vectors)
    slack = 1e-9 * norms * x.norm  # more than matrix products are off
    away = np.zeros((len(q_ids), len(leaves)))
    for p, a, b in zip(q_points.T, low.T, high.T, strict=True):
        away += np.maximum(np.maximum(a - p[:, None], p[:, None] - b), 0) ** 2
    turn = np.argsort(away, axis=1, kind="stable")
    away = np.take_along_axis(away, turn, axis=1)
    worst, done, take = bounds.copy(), np.zeros(len(q_ids), np.int64), 1
    got_q, got_ids, got = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    while True:
        radius = np.full(len(q_ids), np.inf)
        known = worst > -np.inf
        radius[known] = x.radius(worst[known], norms[known])
        stop = np.maximum(done, np.minimum(done + take, (away <= radius[:, None]).sum(axis=1)))
        n = stop - done
        if not n.any():
            return q_ids[got_q], got_ids, got
        q = np.repeat(np.arange(len(q_ids)), n)
        leaf = turn[q, np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n) + done[q]]
        by_leaf = np.argsort(leaf, kind="stable")
        cuts = np.searchsorted(leaf[by_leaf], np.arange(len(leaves) + 1))
        new_q, new_row = [got_q[:0]], [got_q[:0]]
        for t in np.flatnonzero(np.diff(cuts)):
            here = q[by_leaf[cuts[t] : cuts[t + 1]]]
            rows = slice(begin[t], begin[t + 1])
            able = q_vectors[here] @ vectors[rows].T >= (worst - slack)[here, None]
            i, j = np.nonzero(able & (ids[rows] != q_ids[here, None]))
            new_q.append(here[i])
            new_row.append(j + begin[t])
        new_q, new_row = np.concatenate(new_q), np.concatenate(new_row)
        scores = np.concatenate([got, *((vectors[new_row[i : i + PAIRS]] * q_vectors[new_q[i : i + PAIRS]]).sum(axis=1) for i in range(0, len(new_q), PAIRS))])
        of, names = np.append(got_q, new_q), np.append(got_ids, ids[new_row])
        best = np.lexsort((names, -scores, of))
        start = np.searchsorted(of[best], np.arange(len(q_ids)))
        best = best[np.arange(len(best)) - start[of[best]] < k]
        got_q, got_ids, got = of[best], names[best], scores[best]
        full = np.flatnonzero(np.bincount(got_q, minlength=len(q_ids)) == k)
        worst[full] = np.maximum(bounds[full], got[np.searchsorted(got_q, full, "right") - 1])
        done, take = stop, take * 2
