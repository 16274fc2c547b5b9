"""K-means for many k and restarts on a bounded weighted summary of all rows.

The summary is the clustering features of ``ward``: built in partitions, merged as a tree, at most ``leaves`` of them,
and every row counted in one. All restarts of all k run on it. What they find is then measured, and improved by Lloyd's
step, on all rows: one pass serves every k at once and brings back one row a cluster. With no more distinct rows than
``leaves`` the summary is the data.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from .ward import LEAVES, ROWS_AT_ONCE, _vectors, clustering_features, squared_distances

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

SUMS = "model int, cluster int, n long, total array<double>, squares double"
MOST_STEPS = 100


def summary(matrix: DataFrame, leaves: int = LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """(weights, centroids) of at most ``leaves`` features of the ``features`` vectors, sorted by centroid."""
    rows = clustering_features(matrix.select(vector_to_array("features").alias("x")), leaves).collect()
    if not rows:
        return np.zeros(0), np.zeros((0, 0))
    weights = np.array([r["n"] for r in rows])
    centroids = np.array([r["total"] for r in rows]) / weights[:, None]
    order = np.lexsort(centroids.T[::-1])
    return weights[order], centroids[order]


def _spread_seeds(points: np.ndarray, weights: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """``k`` starting centres, each drawn by weight times squared distance to those before it."""
    chosen = [points[random.choice(len(points), p=weights / weights.sum())]]
    gap = squared_distances(points, chosen[0][None])[:, 0]
    while len(chosen) < k:
        mass = weights * gap
        if mass.sum() <= 0:      # fewer distinct points than centres
            break
        chosen.append(points[random.choice(len(points), p=mass / mass.sum())])
        gap = np.minimum(gap, squared_distances(points, chosen[-1][None])[:, 0])
    return np.array(chosen)


def weighted_kmeans(points: np.ndarray, weights: np.ndarray, k: int, restarts: int = 10, seed: int = 42) -> np.ndarray:
    """Centres with the lowest weighted inertia among ``restarts``; fewer than ``k`` if fewer points are distinct."""
    best, lowest = np.zeros((0, points.shape[1])), np.inf
    for attempt in range(restarts):
        centres = _spread_seeds(points, weights, k, np.random.default_rng([seed, k, attempt]))
        home = None
        for _ in range(MOST_STEPS):
            gaps = squared_distances(points, centres)
            found = gaps.argmin(axis=1)
            if home is not None and (found == home).all():
                break
            home = found
            mass = np.bincount(home, weights, len(centres))
            total = np.stack([np.bincount(home, weights * points[:, d], len(centres)) for d in range(points.shape[1])], axis=1)
            held = mass > 0
            centres[held] = total[held] / mass[held, None]
        inertia = float((weights * squared_distances(points, centres).min(axis=1)).sum())
        if inertia < lowest:
            best, lowest = centres, inertia
    return best


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for a in range(0, len(batch), ROWS_AT_ONCE):
            yield _vectors(batch.column("x").slice(a, ROWS_AT_ONCE))


def _sums_of_partition(models: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(c), np.int64) for c in models]
        total, squares = [np.zeros_like(c) for c in models], [np.zeros(len(c)) for c in models]
        for x in _blocks(batches):
            for m, centres in enumerate(models):
                gaps = squared_distances(x, centres)
                home = gaps.argmin(axis=1)
                n[m] += np.bincount(home, minlength=len(centres))
                np.add.at(total[m], home, x)
                squares[m] += np.bincount(home, gaps[np.arange(len(x)), home], len(centres))
        rows = [{"model": m, "cluster": c, "n": int(n[m][c]), "total": total[m][c].tolist(), "squares": float(squares[m][c])}
                for m in range(len(models)) for c in range(len(models[m])) if n[m][c]]
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], kind) for f, kind in zip(rows[0], kinds)], list(rows[0]))

    return run


class Pass:
    """Rows, vector sums and squared distances to the centres of all models over all rows: one pass."""

    def __init__(self, points: DataFrame, models: list[np.ndarray]):
        self.centres = models
        parts = points.mapInArrow(_sums_of_partition(models), SUMS)
        dims = models[0].shape[1]
        sums = parts.groupBy("model", "cluster").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[d]) for d in range(dims)]).alias("total"),
            F.sum("squares").alias("squares")).collect()
        self.n = [np.zeros(len(c)) for c in models]
        self.means, self.squares = [c.copy() for c in models], [np.zeros(len(c)) for c in models]
        for row in sums:
            m, c = row["model"], row["cluster"]
            self.n[m][c], self.squares[m][c] = row["n"], row["squares"]
            self.means[m][c] = np.array(row["total"]) / row["n"]

    def inertia(self) -> list[float]:
        return [float(s.sum()) for s in self.squares]

    def about_means(self, m: int) -> np.ndarray:
        """Squared distances of each cluster's rows to their own mean."""
        moved = ((self.means[m] - self.centres[m]) ** 2).sum(axis=1)
        return np.maximum(self.squares[m] - self.n[m] * moved, 0.0)


def _silhouettes_of_partition(models: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, count = np.zeros(len(models)), 0
        for x in _blocks(batches):
            count += len(x)
            row = np.arange(len(x))
            for m, (centres, n, means, spread) in enumerate(models):
                home = squared_distances(x, centres).argmin(axis=1)
                total = n * squared_distances(x, means) + spread
                inside = total[row, home] / np.maximum(n[home] - 1, 1)
                rivals = np.where(n > 0, total / np.maximum(n, 1), np.inf)
                rivals[row, home] = np.inf
                outside = rivals.min(axis=1)
                larger = np.maximum(inside, outside)
                fine = (n[home] > 1) & np.isfinite(outside) & (larger > 0)
                score[m] += ((outside - inside)[fine] / larger[fine]).sum()
        if count:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(models)), pa.int32()), pa.array(score),
                                              pa.array([count] * len(models), pa.int64())], ["model", "score", "n"])

    return run


def silhouettes(points: DataFrame, measured: Pass) -> list[float]:
    """Mean silhouette with squared distances of every model of a pass: one more pass for all of them."""
    models = [(c, measured.n[m], measured.means[m], measured.about_means(m)) for m, c in enumerate(measured.centres)]
    rows = points.mapInArrow(_silhouettes_of_partition(models), "model int, score double, n long") \
        .groupBy("model").agg((F.sum("score") / F.sum("n")).alias("mean")).collect()
    means = {r["model"]: r["mean"] for r in rows}
    return [means[m] for m in range(len(models))]


class Centres:
    """Fitted centres; ``transform`` adds the nearest one's number as ``cluster``, ties to the smaller."""

    def __init__(self, centres: np.ndarray, inertia: float):
        self.centres, self.inertia = centres, inertia

    @property
    def summary(self) -> SimpleNamespace:
        return SimpleNamespace(trainingCost=self.inertia)

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, matrix: DataFrame, output: str = "cluster") -> DataFrame:
        centres = self.centres

        @F.pandas_udf("int")
        def nearest(vectors: pd.Series) -> pd.Series:
            found = np.zeros(len(vectors), np.int32)
            for a in range(0, len(vectors), ROWS_AT_ONCE):
                x = np.stack(vectors.iloc[a:a + ROWS_AT_ONCE].to_numpy())
                found[a:a + ROWS_AT_ONCE] = squared_distances(x, centres).argmin(axis=1)
            return pd.Series(found)

        return matrix.withColumn(output, nearest(vector_to_array("features")))


def fit_many(points: DataFrame, weights: np.ndarray, centroids: np.ndarray, ks: list[int], restarts: int, seed: int,
             steps: int, tolerance: float = 1e-4) -> Pass:
    """Best centres of every k on the summary, then at most ``steps`` Lloyd steps over all rows, and a last measure.

    Steps end early where no model's inertia fell by more than ``tolerance`` of itself.
    """
    measured = Pass(points, [weighted_kmeans(centroids, weights, k, restarts, seed) for k in ks])
    for _ in range(steps):
        after = Pass(points, measured.means)
        fallen = max(a - b - tolerance * a for a, b in zip(measured.inertia(), after.inertia()))
        measured = after
        if fallen <= 0:
            break
    return measured
