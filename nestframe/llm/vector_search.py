"""Nearest neighbours by low-dimensional stable projections.

Unit vectors are projected on a few Gaussian directions. Gaussians are 2-stable: the squared distance of two
projections, over the squared distance of the vectors, is chi-square distributed with as many degrees of freedom as
there are directions. So a kd-tree over the projections gives candidates in the order of projected distance, each is
verified on the original vectors, and the search stops when a vector nearer than the k-th best would, by the
chi-square distribution, have come up already with the wanted probability.

Distributed, the tree's top is fitted on a bounded sample of projections and deals the vectors into cells, each of
which grows its own tree. A query is first searched in its own cell. The distance it finds there, with the same
chi-square test, tells which other cells can still hold something nearer, and only these see it.

Equal vectors count as one, with the smallest ids kept, as many as a result can name; so a third of all vectors may be
equal and still no cell is larger than others.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from math import exp, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestframe.llm.labelled import by_lot
from nestframe.operators.durable import durable

#: Directions; even, as the chi-square distribution then has a short form.
DIRECTIONS = 8
#: Projections the top of the tree is fitted on at most, and so its cells at most; over a billion vectors want more.
SAMPLED = 20_000
_LEAF = 128


def chi_square(x: float, degrees: int = DIRECTIONS) -> float:
    """The distribution function for an even number of degrees."""
    half, term, total = x / 2, 1.0, 1.0
    if half > 300:
        return 1.0
    for i in range(1, degrees // 2):
        term *= half / i
        total += term
    return 1 - exp(-half) * total


def chi_square_quantile(p: float, degrees: int = DIRECTIONS) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < p else (low, middle)
    return high


class Tree:
    """A kd-tree: inner nodes split the widest direction at the median, leaves hold a few points."""

    def __init__(self, points: np.ndarray, leaf: int = _LEAF):
        self.points = points
        self.nodes: list[tuple] = []
        self._grow(np.arange(len(points)), leaf)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        number = len(self.nodes)
        self.nodes.append(())
        spread = np.ptp(self.points[rows], axis=0) if len(rows) else np.zeros(1)
        axis = int(spread.argmax())
        if len(rows) <= leaf or spread[axis] == 0:
            self.nodes[number] = (-1, 0.0, rows, 0)
            return number
        values = self.points[rows, axis]
        cut = float(np.median(values))
        left = values < cut
        if not left.any():  # more than half lie on the smallest value
            left = values <= cut
        self.nodes[number] = (axis, float(values[~left].min()), self._grow(rows[left], leaf), self._grow(rows[~left], leaf))
        return number

    def leaves(self, point: np.ndarray):
        """The leaves from near to far: squared distance at least, number of the node."""
        heap = [(0.0, 0, 0, np.zeros(len(point)))]
        tie = 0
        while heap:
            near, _, number, offset = heapq.heappop(heap)
            axis, cut, left, right = self.nodes[number]
            while axis >= 0:
                gap = point[axis] - cut
                number, far = (left, right) if gap < 0 else (right, left)
                other = offset.copy()
                other[axis] = gap
                tie += 1
                heapq.heappush(heap, (near - offset[axis] ** 2 + gap**2, tie, far, other))
                axis, cut, left, right = self.nodes[number]
            yield near, number

    def packed(self) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
        """The points leaf after leaf, and where each leaf begins and ends there."""
        leaves = [(number, node[2]) for number, node in enumerate(self.nodes) if node[0] < 0]
        ends = np.cumsum([len(rows) for _, rows in leaves]).tolist()
        bounds = {number: (end - len(rows), end) for (number, rows), end in zip(leaves, ends, strict=True)}
        return np.concatenate([rows for _, rows in leaves]), bounds

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf each point falls in."""
        result = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            number, rows = todo.pop()
            axis, cut, left, right = self.nodes[number]
            if axis < 0:
                result[rows] = number
                continue
            low = points[rows, axis] < cut
            todo += [(left, rows[low]), (right, rows[~low])]
        return result

    def within(self, point: np.ndarray, radius: float) -> list[int]:
        """The leaves that are no farther, by squared distance."""
        found, todo = [], [(0, 0.0, np.zeros(len(point)))]
        while todo:
            number, near, offset = todo.pop()
            axis, cut, left, right = self.nodes[number]
            if axis < 0:
                found.append(number)
                continue
            gap = point[axis] - cut
            same, far = (left, right) if gap < 0 else (right, left)
            todo.append((same, near, offset))
            further = near - offset[axis] ** 2 + gap**2
            if further <= radius:
                other = offset.copy()
                other[axis] = gap
                todo.append((far, further, other))
        return found


def nearest_vectors(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    probability: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cell_size: int = 8192,
    seed: int = 7,
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` found of largest cosine for each query, itself not counted.

    Ties go to the smaller id. Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    rows with a null id, nor vectors of another length than the most frequent one. Rows with the same id and vector
    count as one; an id with several vectors may be found for each. Fewer candidates give fewer rows.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), is_query.alias("asks"), F.col(vector_column).cast("array<double>").alias("v"))
    usable = F.col("id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    rows = rows.where(usable).where(F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dimension = sizes.n if sizes else 1
    rows = rows.where(F.size("v") == dimension)
    directions = np.random.default_rng(seed).standard_normal((dimension, DIRECTIONS))
    # The key of equal vectors is their content; a query has its own neighbours besides itself, hence k + 1.
    place = Window.partitionBy("key").orderBy("id")
    keyed = rows.withColumn("key", F.sha2(F.array_join("v", ",").cast("binary"), 256)).distinct()
    first = durable(keyed.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1).drop("asks"))
    first = first.groupBy("key").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))

    def project(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), dimension)
            points = _unit(v) @ directions
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(points), pa.list_(pa.float64()))], [*batch.schema.names, "p"])

    known = durable(first.mapInArrow(project, "key string, v array<double>, ids array<long>, p array<double>"))
    asked = keyed.where("asks").select("id", "key", "v").mapInArrow(project, "id long, key string, v array<double>, p array<double>")
    count = known.count()
    share = min(1.0, SAMPLED / max(count, 1))
    sample = known.where(by_lot(share, "key")).select("key", "p")
    points = np.array([row.p for row in sorted(sample.collect(), key=lambda row: row.key)]).reshape(-1, DIRECTIONS)
    top = Tree(points, max(1, int(len(points) * cell_size / max(count, 1))) if len(points) else 1)
    del points, sample
    top.points = np.zeros((0, DIRECTIONS))
    top.nodes = [(a, c, 0 if a < 0 else left, right) for a, c, left, right in top.nodes]
    radius = chi_square_quantile(probability)

    def deal(batches):
        for batch in batches:
            cells = top.cell_of(_matrix(batch.column("p"), DIRECTIONS))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])

    cells = known.mapInArrow(deal, "key string, v array<double>, ids array<long>, p array<double>, cell long")
    home = asked.mapInArrow(deal, "id long, key string, v array<double>, p array<double>, cell long")
    home = durable(home.withColumn("bound", F.lit(float("inf"))))
    found = "id long, vec long, score double"
    near = durable(cells.groupBy("cell").cogroup(home.groupBy("cell")).applyInArrow(_search(k, dimension, radius), found))
    worst = near.groupBy("id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bound = F.when(F.col("n") >= k, F.greatest(2 - 2 * F.col("least"), F.lit(0.0))).otherwise(float("inf"))
    bounded = home.drop("bound").join(worst.select("id", bound.alias("bound")), "id", "left").fillna(float("inf"), ["bound"])

    def others(batches):
        for batch in batches:
            points, own, bounds = _matrix(batch.column("p"), DIRECTIONS), batch.column("cell").to_pylist(), batch.column("bound").to_pylist()
            more = [[c for c in top.within(p, b * radius) if c != o] for p, o, b in zip(points, own, bounds, strict=True)]
            rows = batch.take(pa.array(np.repeat(np.arange(len(more)), [len(m) for m in more])))
            columns = [rows.column(name) for name in ("id", "key", "v", "p", "bound")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([c for m in more for c in m], pa.int64())], ["id", "key", "v", "p", "bound", "cell"])

    away = bounded.mapInArrow(others, "id long, key string, v array<double>, p array<double>, bound double, cell long")
    far = cells.groupBy("cell").cogroup(away.groupBy("cell")).applyInArrow(_search(k, dimension, radius), found)
    best = Window.partitionBy("id").orderBy(F.desc("score"), "vec")
    ranked = near.unionByName(far).distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("vec").alias(id_column), "score")


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def _unit(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1, keepdims=True)  # so that no square overflows
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The cosine in double precision."""
    dots = (vectors * query).sum(axis=1)
    return dots / (np.sqrt((vectors**2).sum(axis=1)) * np.sqrt((query**2).sum()))


def _search(k: int, dimension: int, radius: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(cell: pa.Table, queries: pa.Table) -> pa.Table:
        ids, found, scores = [], [], []
        if cell.num_rows and queries.num_rows:
            # In the order of keys, so that a repeated run gives the same.
            cell = cell.sort_by("key")
            vectors, points = _matrix(cell.column("v"), dimension), _matrix(cell.column("p"), DIRECTIONS)
            names = cell.column("ids").to_pylist()
            # In the order of leaves, so that a leaf is a slice.
            tree = Tree(points)
            order, leaf_at = tree.packed()
            vectors, points, names = vectors[order], points[order], [names[i] for i in order.tolist()]
            units = _unit(vectors)
            asked, places = _matrix(queries.column("v"), dimension), _matrix(queries.column("p"), DIRECTIONS)
            directions = _unit(asked)
            for own, bound, v, p, u in zip(
                queries.column("id").to_pylist(), queries.column("bound").to_pylist(), asked, places, directions, strict=True
            ):
                best: list[tuple[float, int]] = []
                limit = bound
                for near, leaf in tree.leaves(p):
                    # Had anything nearer than the limit been left, its projection would most likely be nearer as well.
                    if near > radius * limit:
                        break
                    first, last = leaf_at[leaf]
                    away = points[first:last] - p
                    close = np.einsum("ij,ij->i", away, away) <= radius * limit
                    if len(best) == k:
                        # What rounding could not bring among the best need not be looked at exactly.
                        close &= units[first:last] @ u >= -best[-1][0] - 1e-9
                    close = np.flatnonzero(close) + first
                    if not len(close):
                        continue
                    exact = cosines(v, vectors[close])
                    best += [(-score, i) for score, row in zip(exact.tolist(), close.tolist(), strict=True) for i in names[row] if i != own]
                    best = sorted(best)[:k]
                    if len(best) == k:
                        limit = min(bound, max(0.0, 2 + 2 * best[-1][0]))
                ids += [own] * len(best)
                found += [i for _, i in best]
                scores += [-s for s, _ in best]
        return pa.table({"id": pa.array(ids, pa.int64()), "vec": pa.array(found, pa.int64()), "score": pa.array(scores, pa.float64())})

    return search
