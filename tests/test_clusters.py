"""Clustering against brute force on small frames."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from vitrine.operators import cluster_metrics, clustering, components, dbscan


def brute_dbscan(points, eps, min_samples):
    n = len(points)
    square = sum((points[:, None, d] - points[None, :, d]) ** 2 for d in range(points.shape[1]))
    near = square <= eps * eps
    core = near.sum(1) >= min_samples
    labels, cluster = np.full(n, -1), 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack, labels[i] = [i], cluster
        while stack:
            j = stack.pop()
            for k in np.flatnonzero(near[j]):
                if labels[k] == -1:
                    labels[k] = cluster
                    if core[k]:
                        stack.append(k)
        cluster += 1
    return labels, core


def run_dbscan(spark, points, eps, min_samples, **options):
    names = [f"x{d}" for d in range(points.shape[1])]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)],
                               "k long, " + ", ".join(f"{n} double" for n in names))
    rows = dbscan.dbscan(df, "k", names, eps, min_samples, **options).orderBy("k").collect()
    return np.array([r.dbscan_label for r in rows]), np.array([bool(r.is_core) for r in rows])


def blobs(seed, dims):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(c, 0.18, (60, dims)) for c in (0.0, 2.0, 4.5)] + [rng.uniform(-2, 7, (40, dims))]
    points = np.concatenate(parts)
    points = np.concatenate([points, points[:25]])  # exact copies
    return points[rng.permutation(len(points))]


@pytest.mark.parametrize("seed, dims, eps, min_samples", [(1, 2, 0.3, 6), (2, 3, 0.5, 5), (3, 2, 0.9, 10)])
def test_dbscan_matches_brute_force(spark, seed, dims, eps, min_samples):
    points = blobs(seed, dims)
    labels, core = brute_dbscan(points, eps, min_samples)
    got, got_core = run_dbscan(spark, points, eps, min_samples)
    assert (got_core == core).all() and (got == labels).all()
    assert labels.max() >= 1


def test_dbscan_splits_dense_cells(spark):
    """Two dense cells joined only near their border, decided after splitting."""
    rng = np.random.default_rng(5)
    side = 1.0 / np.sqrt(2)
    left = rng.uniform((0.0, 0.0), (side * 0.9, side * 0.9), (150, 2))
    right = rng.uniform((side * 2.2, 0.0), (side * 2.9, side * 0.9), (150, 2))
    far = rng.uniform((10.0, 10.0), (10.5, 10.5), (50, 2))
    points = np.concatenate([left, right, far])
    labels, core = brute_dbscan(points, 1.0, 5)
    for budget in (1, 4, 4096):
        got, got_core = run_dbscan(spark, points, 1.0, 5, pair_budget=budget)
        assert (got_core == core).all() and (got == labels).all()


def test_dbscan_hot_copies_noise_and_edges(spark):
    copies = np.zeros((300, 2))
    exact = np.array([[1.0, 0.0], [2.0, 0.0], [3.0001, 0.0]])
    points = np.concatenate([copies, exact])
    labels, core = brute_dbscan(points, 1.0, 3)
    got, got_core = run_dbscan(spark, points, 1.0, 3)
    assert (got == labels).all() and (got_core == core).all()
    lonely = np.arange(10.0).reshape(-1, 1) * 5
    assert set(run_dbscan(spark, lonely, 1.0, 2)[0]) == {-1}


def test_border_takes_first_cluster(spark):
    left = [[-0.9 - 0.01 * i, 0.0] for i in range(5)]
    right = [[0.9 + 0.01 * i, 0.0] for i in range(5)]
    points = np.array(right + [[0.0, 0.0]] + left)
    labels, _ = brute_dbscan(points, 0.9, 5)
    got, _ = run_dbscan(spark, points, 0.9, 5)
    assert (got == labels).all() and got[5] == 0 and got[6] == 1


def test_components_of_a_chain(spark):
    nodes = spark.range(60)
    edges = spark.range(49).selectExpr("id AS a", "id + 1 AS b")
    comps = {r.id: r.comp for r in components.connected_components(nodes, edges).collect()}
    assert all(comps[i] == 0 for i in range(50)) and all(comps[i] == i for i in range(50, 60))


def chain_and_star(n, seed):
    """A chain with shuffled ids, and a hub with as many leaves."""
    ids = np.random.default_rng(seed).permutation(n).tolist()
    return [(ids[i], ids[i + 1]) for i in range(n - 1)] + [(n + n // 2, n + i) for i in range(n) if i != n // 2]


def test_components_take_few_rounds(spark):
    n = 10_000
    edges = spark.createDataFrame(chain_and_star(n, 5), "a long, b long")
    stars, rounds = components.contract(edges)
    assert {(r.a, r.b) for r in stars.collect()} == {(i, 0) for i in range(1, n)} | {(n + i, n) for i in range(1, n)}
    assert rounds < 3 * np.log2(n)


def brute_silhouette(points, labels, power):
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)) ** power
    scores = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == g].mean() for g in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(11)
    points = rng.normal(size=(120, 3))
    labels = rng.integers(0, 3, 120)
    points[labels == 1] += 2.0
    labels[0] = 9  # a cluster of one
    df = spark.createDataFrame([(i, int(g), *map(float, p)) for i, (g, p) in enumerate(zip(labels, points))],
                               "product_id int, g int, a double, b double, c double")
    return df, points, labels


def test_silhouettes(labelled):
    df, points, labels = labelled
    exact = cluster_metrics.silhouette(df, "product_id", "g", ["a", "b", "c"], block_rows=17).first()[0]
    squared = cluster_metrics.silhouette_squared(df, "g", ["a", "b", "c"]).first()[0]
    assert exact == pytest.approx(brute_silhouette(points, labels, 1), abs=1e-5)
    assert squared == pytest.approx(brute_silhouette(points, labels, 2), abs=1e-5)
    vector = clustering.assemble(df.where("g <> 9"), ["a", "b", "c"])
    builtin = ClusteringEvaluator(predictionCol="g").evaluate(vector)
    ours = cluster_metrics.silhouette_squared(df.where("g <> 9"), "g", ["a", "b", "c"]).first()[0]
    assert ours == pytest.approx(builtin, abs=1e-5)


def test_davies_bouldin(labelled):
    df, points, labels = labelled
    ids = sorted(set(labels))
    centers = {g: points[labels == g].mean(0) for g in ids}
    spread = {g: np.linalg.norm(points[labels == g] - centers[g], axis=1).mean() for g in ids}
    truth = np.mean([max((spread[a] + spread[b]) / np.linalg.norm(centers[a] - centers[b]) for b in ids if b != a) for a in ids])
    assert cluster_metrics.davies_bouldin(df, "g", ["a", "b", "c"]).first()[0] == pytest.approx(truth, abs=1e-5)


def test_kmeans_and_pca(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(p), float(q), float(p + rng.normal(0, 0.1))) for i, (p, q) in
            enumerate(np.concatenate([rng.normal((5, 1), 0.3, (40, 2)), rng.normal((50, 3), 0.3, (40, 2)), rng.normal((200, 9), 0.3, (40, 2))]))]
    df = spark.createDataFrame(rows, "product_id int, prix double, rating double, nb_reviews double")
    matrix, scaled = clustering.feature_matrix(df)
    named, model = clustering.kmeans_segments(matrix, 3, restarts=2)
    means = {r.cluster_label: r.m for r in named.groupBy("cluster_label").agg(F.avg("prix").alias("m")).collect()}
    assert means["Discount"] < means["Populaire"] < means["Premium"]
    data = np.array([[r[s] for s in scaled] for r in named.orderBy("product_id").collect()])
    centers = np.array([c for c in model.clusterCenters()])
    nearest = ((data[:, None] - centers[None]) ** 2).sum(-1)
    assert [r.cluster_kmeans for r in named.orderBy("product_id").collect()] == list(nearest.argmin(1))
    assert model.summary.trainingCost == pytest.approx(nearest.min(1).sum(), rel=1e-6)
    projected, loadings = clustering.pca_2d(matrix, scaled)
    values, vectors = np.linalg.eigh(np.cov(data.T))
    table = loadings.collect()
    first = np.array([r.loading for r in table if r.component == "PC1"])
    assert abs(first @ vectors[:, -1]) == pytest.approx(1.0, abs=1e-6) and first[abs(first).argmax()] > 0
    assert table[0].variance_share == pytest.approx(values[-1] / values.sum(), abs=1e-6)
    got = np.array([r.PC1 for r in projected.orderBy("product_id").collect()])
    assert got == pytest.approx(data @ first, abs=1e-6)


def test_elbow_falls(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(rng.normal(size=(80, 2)))], "product_id int, prix double, rating double")
    matrix, scaled = clustering.feature_matrix(df)
    table = clustering.elbow(matrix, scaled, k_max=4, restarts=3, exact=True).orderBy("k").collect()
    assert [r.k for r in table] == [2, 3, 4] and table[0].inertia > table[-1].inertia
    assert all(-1 <= r.silhouette <= 1 for r in table)


def test_anomaly_summary(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (-1, 1)], "dbscan_label int, is_anomalie int")
    row = dbscan.anomaly_summary(df).first()
    assert (row.n_clusters, row.n_anomalies, row.pct_anomalies) == (2, 1, 25.0)


def test_dense_cells_are_counted_by_nodes(spark):
    """A third of all points in one cell, and sparse points around it that see parts of it."""
    rng = np.random.default_rng(11)
    side = 0.5 / np.sqrt(2)
    dense = rng.uniform(0.02, side - 0.02, (900, 2))
    ring = rng.uniform(-0.9, 0.9 + side, (500, 2))
    lines = np.stack([np.linspace(-3, 3, 800), np.full(800, 2.5)], axis=1)
    points = np.concatenate([dense, ring, lines])[rng.permutation(2200)]
    for min_samples in (40, 400):
        labels, core = brute_dbscan(points, 0.5, min_samples)
        got, got_core = run_dbscan(spark, points, 0.5, min_samples, leaf=8)
        assert (got_core == core).all() and (got == labels).all()
        assert core.any() and not core.all()


def test_descent_lists_few_points_of_a_dense_cell(spark):
    space = dbscan._Space(2, 1.0)
    rng = np.random.default_rng(12)
    inside = rng.uniform(0, space.side, (4000, 2))
    points = spark.createDataFrame([(7, [float(a), float(b)], 2) for a, b in inside], "cell_id long, x array<double>, w long")
    pairs = spark.createDataFrame([(1, [1.2, 0.3], [1.2, 0.3], 7, 8000, 4000, inside.min(0).tolist(), inside.max(0).tolist())],
                                  "a_id long, a_lo array<double>, a_hi array<double>, b_id long, b_n long, b_pts long, "
                                  "b_lo array<double>, b_hi array<double>")
    whole, nodes = dbscan._descend(pairs, points, space, 16)
    listed = nodes.agg(F.sum("n")).first()[0] / 2
    assert listed < 400
    near = dbscan._point_by_point(nodes.withColumn("x", F.array(F.lit(1.2), F.lit(0.3))), points, space, "a_id")
    total = whole.agg(F.sum("n")).first()[0] + near.agg(F.sum("w")).first()[0]
    assert total == 2 * int((((inside - [1.2, 0.3]) ** 2).sum(axis=1) <= 1).sum())
