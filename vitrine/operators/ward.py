"""Ward's hierarchy over all rows, through clustering features.

A clustering feature is the weight, the vector sum and the sum of squares of the rows it has absorbed. Each partition
reads its rows once and keeps at most ``leaves`` features: a row goes to the nearest feature within the current
threshold or opens a new one, and where there are too many the threshold rises and the features absorb each other. The
lists of the partitions are merged as a tree, a few lists a task, so neither a task nor the driver ever holds more than
a bounded number of features. Ward's hierarchy of the last list is found by nearest-neighbour chains, exactly, with each
feature counting as the rows in it. Every row belongs to the feature of the nearest centroid.

With no more distinct rows than ``leaves``, each of them is a feature of its own and the hierarchy is Ward's over all
rows. With more, features are ball-shaped groups of rows, and which rows share one may depend on the partitions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..session import store_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

LEAVES = 2048
ROWS_AT_ONCE = 1024
FAN_IN = 8
FEATURE = "n double, total array<double>, squares double, threshold double"


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by differences, as sums of products lose the small ones."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        out += (a[:, i, None] - b[None, :, i]) ** 2
    return out


class FeatureList:
    """At most ``leaves`` clustering features; ``threshold`` is the squared distance within which one absorbs."""

    def __init__(self, dims: int, leaves: int, threshold: float = 0.0):
        self.leaves, self.threshold = leaves, threshold
        self.n, self.total, self.squares = np.zeros(0), np.zeros((0, dims)), np.zeros(0)

    def centroids(self) -> np.ndarray:
        return self.total / self.n[:, None]

    def add(self, n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> None:
        """Absorb features, in their order."""
        for a in range(0, len(n), ROWS_AT_ONCE):
            part = slice(a, a + ROWS_AT_ONCE)
            self._absorb(n[part], total[part], squares[part])
            while len(self.n) > self.leaves:
                self._condense()

    def _absorb(self, n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> None:
        points = total / n[:, None]
        home = np.full(len(n), -1)
        if len(self.n):
            gaps = squared_distances(points, self.centroids())
            near = gaps.argmin(axis=1)
            inside = gaps[np.arange(len(n)), near] <= self.threshold
            home[inside] = near[inside]
        left, opened = np.flatnonzero(home < 0), len(self.n)
        while len(left):
            close = squared_distances(points[left[:1]], points[left])[0] <= self.threshold
            home[left[close]], opened = opened, opened + 1
            left = left[~close]
        fresh = opened - len(self.n)
        self.n = np.concatenate([self.n, np.zeros(fresh)])
        self.total = np.concatenate([self.total, np.zeros((fresh, self.total.shape[1]))])
        self.squares = np.concatenate([self.squares, np.zeros(fresh)])
        np.add.at(self.n, home, n)
        np.add.at(self.total, home, total)
        np.add.at(self.squares, home, squares)

    def _condense(self) -> None:
        """Raise the threshold to the median distance between nearest features and absorb the light into the heavy."""
        gaps = squared_distances(self.centroids(), self.centroids())
        np.fill_diagonal(gaps, np.inf)
        self.threshold = max(2 * self.threshold, float(np.median(gaps.min(axis=1))))
        order = np.lexsort((*self.total.T, -self.n))
        n, total, squares = self.n[order], self.total[order], self.squares[order]
        self.n, self.total, self.squares = self.n[:0], self.total[:0], self.squares[:0]
        for a in range(0, len(n), ROWS_AT_ONCE):
            part = slice(a, a + ROWS_AT_ONCE)
            self._absorb(n[part], total[part], squares[part])

    def table(self) -> dict[str, pa.Array]:
        return {"n": pa.array(self.n), "total": pa.array(self.total.tolist(), pa.list_(pa.float64())),
                "squares": pa.array(self.squares), "threshold": pa.array(np.full(len(self.n), self.threshold))}


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def _of_partition(leaves: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = None
        for batch in batches:
            if not len(batch):
                continue
            points = _vectors(batch.column("x"))
            found = found or FeatureList(points.shape[1], leaves)
            found.add(np.ones(len(points)), points, (points ** 2).sum(axis=1))
        if found is not None:
            columns = found.table()
            part = pa.array([TaskContext.get().partitionId()] * len(found.n), pa.int32())
            yield pa.RecordBatch.from_arrays([part, *columns.values()], ["part", *columns])

    return run


def _merged(leaves: int):
    def run(key: tuple, features: pa.Table) -> pa.Table:
        features = features.sort_by("part")
        total = _vectors(features["total"].combine_chunks())
        found = FeatureList(total.shape[1], leaves, float(features["threshold"].to_numpy().max()))
        found.add(features["n"].to_numpy(), total, features["squares"].to_numpy())
        return pa.table({"part": pa.array([key[0].as_py()] * len(found.n), pa.int32()), **found.table()})

    return run


def clustering_features(points: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """``n``, ``total`` and ``squares`` of at most ``leaves`` features of the vectors ``x`` (array of double)."""
    schema = f"part int, {FEATURE}"
    lists = store_table(points.select("x").mapInArrow(_of_partition(leaves), schema), "features")
    parts = lists.agg(F.max("part")).first()[0] or 0
    while parts > 0:
        grouped = lists.withColumn("place", F.col("part")).withColumn("part", F.expr(f"part div {FAN_IN}"))
        grouped = grouped.select(F.col("part").alias("group"), F.col("place").alias("part"), "n", "total", "squares", "threshold")
        lists = store_table(grouped.groupBy("group").applyInArrow(_merged(leaves), schema), "features")
        parts //= FAN_IN
    return lists.select("n", "total", "squares")


def ward_chain(n: np.ndarray, centroids: np.ndarray) -> list[tuple[int, int, float, float]]:
    """Merges (left, right, height, rows) of weighted points by ascending height.

    Points are numbered from 0, the i-th merge is cluster ``len(n) + i``, and a height is the root of twice the growth
    of the sum of squares, which is the distance for two single rows.
    """
    size = len(n)
    gap = squared_distances(centroids, centroids) * (2 * n[:, None] * n[None, :] / (n[:, None] + n[None, :]))
    np.fill_diagonal(gap, np.inf)
    weight, alive, chain, merges = n.astype(float).copy(), np.ones(size, bool), [], []
    for _ in range(size - 1):
        if not chain:
            chain = [int(np.argmax(alive))]
        while True:
            last = chain[-1]
            nearest = int(np.argmin(gap[last]))
            if len(chain) > 1 and gap[last, chain[-2]] <= gap[last, nearest]:
                nearest = chain[-2]
                break
            chain.append(nearest)
        a, b = sorted((chain.pop(), chain.pop()))
        height = gap[a, b]
        others = alive.copy()
        others[[a, b]] = False
        total = weight + weight[a] + weight[b]
        merged = ((weight + weight[a]) * gap[a] + (weight + weight[b]) * gap[b] - weight * height) / total
        merges.append((height, a, b, weight[a] + weight[b]))
        gap[a, others] = gap[others, a] = merged[others]
        gap[b, :] = gap[:, b] = np.inf
        weight[a] += weight[b]
        alive[b] = False
    # A chain finds merges out of order; sorted by height they are the hierarchy.
    merges.sort(key=lambda m: m[0])
    name, out = list(range(size)), []
    root = list(range(size))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for step, (height, a, b, rows) in enumerate(merges):
        a, b = find(a), find(b)
        left, right = sorted((name[a], name[b]))
        out.append((left, right, float(np.sqrt(max(height, 0.0))), float(rows)))
        root[b] = a
        name[a] = size + step
    return out


def cut(merges: list[tuple[int, int, float, float]], size: int, k: int) -> np.ndarray:
    """Cluster of each of ``size`` points after all but the last ``k`` - 1 merges, numbered by their first point."""
    root = np.arange(2 * size)
    for step, (left, right, _, _) in enumerate(merges[:max(0, size - k)]):
        root[left] = root[right] = size + step
    for i in range(len(root) - 1, -1, -1):
        root[i] = root[root[i]]
    _, first, label = np.unique(root[:size], return_index=True, return_inverse=True)
    return np.argsort(np.argsort(first))[label]


class Ward:
    """The hierarchy of a frame's ``features`` vectors.

    ``leaves`` bounds what the driver holds: centroids and merges of that many features, whatever the number of rows.
    """

    def __init__(self, matrix: DataFrame, leaves: int = LEAVES):
        points = matrix.select(vector_to_array("features").alias("x"))
        rows = clustering_features(points, leaves).collect()
        order = sorted(range(len(rows)), key=lambda i: [t / rows[i]["n"] for t in rows[i]["total"]])
        self.n = np.array([rows[i]["n"] for i in order])
        self.centroids = np.array([[t / rows[i]["n"] for t in rows[i]["total"]] for i in order])
        self.merges = ward_chain(self.n, self.centroids) if len(rows) else []
        self.spark = matrix.sparkSession

    def linkage(self) -> DataFrame:
        """``step``, ``left``, ``right``, ``height`` and ``rows`` of every merge; features are numbered by centroid."""
        return self.spark.createDataFrame(
            [(i, int(a), int(b), h, r) for i, (a, b, h, r) in enumerate(self.merges)],
            "step int, left int, right int, height double, rows double")

    def label(self, matrix: DataFrame, k: int, output: str = "cluster_hierarch") -> DataFrame:
        """Rows with the cluster of their nearest feature; clusters are numbered by their first feature."""
        labels, centroids = cut(self.merges, len(self.n), k).astype(np.int32), self.centroids

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = np.zeros(len(batch), np.int32)
                for a in range(0, len(batch), ROWS_AT_ONCE):
                    x = _vectors(batch.column("x").slice(a, ROWS_AT_ONCE))
                    found[a:a + ROWS_AT_ONCE] = labels[squared_distances(x, centroids).argmin(axis=1)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, output])

        rest = [c for c in matrix.columns if c not in ("features", output)]
        schema = ", ".join(f"`{c}` {matrix.schema[c].dataType.simpleString()}" for c in rest)
        labelled = matrix.select(*rest, vector_to_array("features").alias("x")).mapInArrow(
            run, f"{schema}, x array<double>, `{output}` int")
        return labelled.withColumn("features", array_to_vector("x")).drop("x")
