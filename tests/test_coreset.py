"""K-means on clustering features: against full fits, direct sums, and tables without enough rows."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from vitrine.operators import clustering, coreset

NAMES = ["prix", "rating", "nb_reviews"]


def matrix_of(spark, points, parts=5):
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "product_id int, prix double, rating double, nb_reviews double").repartition(parts)
    return clustering.feature_matrix(df)


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 3)) * 5
    hot = rng.normal(centres[0], 0.05, (1500, 3))      # a third of all rows in one place
    return np.concatenate([hot, *[rng.normal(c, 0.8, (600, 3)) for c in centres[1:]]])


def full_fit(matrix, k, restarts):
    fits = [KMeans(k=k, seed=42 + s).fit(matrix) for s in range(restarts)]
    return min(f.summary.trainingCost for f in fits)


def test_inertia_is_close_to_full_fits(spark, blobs):
    matrix, scaled = matrix_of(spark, blobs)
    matrix = matrix.cache()
    coarse = {r.k: r for r in clustering.elbow(matrix, scaled, k_max=6, leaves=96).collect()}
    for k in (3, 6):
        assert coarse[k].inertia <= 1.02 * full_fit(matrix, k, 2)
    matrix.unpersist()


def test_measures_are_over_all_rows(spark, blobs):
    matrix, scaled = matrix_of(spark, blobs)
    model = clustering.best_kmeans(matrix, 4, leaves=64)
    rows = model.transform(matrix)
    data = np.array([[r[s] for s in scaled] for r in rows.select(*scaled).collect()])
    gaps = ((data[:, None] - model.centres[None]) ** 2).sum(-1)
    assert model.inertia == pytest.approx(gaps.min(1).sum(), rel=1e-9)
    points = matrix.select(clustering.vector_to_array("features").alias("x"))
    measured = coreset.Pass(points, [model.centres])
    assert measured.n[0].sum() == len(blobs)
    builtin = ClusteringEvaluator(predictionCol="cluster").evaluate(rows.withColumn("cluster", F.col("cluster").cast("double")))
    assert coreset.silhouettes(points, measured)[0] == pytest.approx(builtin, abs=1e-6)


def test_result_does_not_depend_on_partitions_when_rows_fit(spark, blobs):
    few = blobs[::10]
    a = clustering.elbow(*matrix_of(spark, few, 1), k_max=4).collect()
    b = clustering.elbow(*matrix_of(spark, few, 7), k_max=4).collect()
    assert [r.inertia for r in a] == pytest.approx([r.inertia for r in b], rel=1e-9)


def test_fewer_distinct_rows_than_clusters(spark):
    matrix, scaled = matrix_of(spark, [(1, 2, 3)] * 5 + [(4, 4, 4)] * 3)
    table = clustering.elbow(matrix, scaled, k_max=4).collect()
    assert [r.k for r in table] == [2, 3, 4] and all(r.inertia == pytest.approx(0, abs=1e-12) for r in table)
    model = clustering.best_kmeans(matrix, 5)
    assert len(model.clusterCenters()) == 2 and model.transform(matrix).count() == 8


def test_empty_matrix(spark):
    matrix, scaled = matrix_of(spark, [(1, 2, 3)])
    none = matrix.where("product_id < 0")
    assert clustering.elbow(none, scaled).collect() == []
    with pytest.raises(ValueError):
        clustering.best_kmeans(none, 3)
