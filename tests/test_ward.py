"""Ward's hierarchy against a plain merge of the closest pair."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from vitrine.operators import clustering, ward
from vitrine.operators.features import assemble


def naive_ward(n, centroids):
    """Merge the pair whose sum of squares grows least, over and over."""
    clusters, out = {i: (n[i], centroids[i]) for i in range(len(n))}, []
    while len(clusters) > 1:
        pairs = [(2 * clusters[a][0] * clusters[b][0] / (clusters[a][0] + clusters[b][0])
                  * ((clusters[a][1] - clusters[b][1]) ** 2).sum(), a, b) for a in clusters for b in clusters if a < b]
        height, a, b = min(pairs)
        (na, ca), (nb, cb) = clusters.pop(a), clusters.pop(b)
        clusters[len(n) + len(out)] = (na + nb, (na * ca + nb * cb) / (na + nb))
        out.append((a, b, np.sqrt(height), na + nb))
    return out


def frame(spark, points):
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)],
                               "k long, " + ", ".join(f"x{d} double" for d in range(points.shape[1])))
    return assemble(df.repartition(5, "k"), [f"x{d}" for d in range(points.shape[1])])


def test_chain_equals_naive_merging():
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 9, 24):
        n, c = rng.integers(1, 6, size).astype(float), rng.normal(size=(size, 3))
        got, want = ward.ward_chain(n, c), naive_ward(n, c)
        assert [m[:2] for m in got] == [m[:2] for m in want]
        assert not want or np.allclose([m[2:] for m in got], [m[2:] for m in want])


def test_hierarchy_equals_ward_where_every_row_is_a_leaf(spark):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 0.4, (13, 2)) for c in (0, 3, 7)])
    points = np.concatenate([points, points[:6]])  # equal rows share a leaf of their weight
    matrix = frame(spark, points)
    order = np.array(sorted({tuple(p) for p in points.tolist()}))
    weight = np.array([(points == p).all(axis=1).sum() for p in order], float)
    want = naive_ward(weight, order)
    got = ward.Ward(matrix).linkage().orderBy("step").collect()
    assert [(r["left"], r["right"]) for r in got] == [m[:2] for m in want]
    assert np.allclose([(r["height"], r["rows"]) for r in got], [m[2:] for m in want])
    for k in (1, 2, 3, 5):
        members = {i: [i] for i in range(len(order))}
        for step, (a, b, *_) in enumerate(want[:len(order) - k]):
            members[len(order) + step] = members.pop(a) + members.pop(b)
        label_of = {}
        for number, group in enumerate(sorted(members.values(), key=min)):
            label_of |= {tuple(order[i]): number for i in group}
        rows = clustering.hierarchical_segments(matrix, k).select("k", "cluster_hierarch").collect()
        assert {r["k"]: r["cluster_hierarch"] for r in rows} == {i: label_of[tuple(p)] for i, p in enumerate(points.tolist())}


@pytest.mark.parametrize("partitions", [1, 20])
def test_bounded_features_lose_no_row(spark, partitions):
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.normal(c, 0.3, (400, 3)) for c in (0.0, 4.0, 9.0)])
    matrix = frame(spark, points).repartition(partitions)
    from pyspark.ml.functions import vector_to_array
    features = ward.clustering_features(matrix.select(vector_to_array("features").alias("x")), leaves=40).collect()
    assert 3 <= len(features) <= 40 and sum(r["n"] for r in features) == len(points)
    assert np.allclose(np.sum([r["total"] for r in features], axis=0), points.sum(axis=0))
    assert np.isclose(sum(r["squares"] for r in features), (points ** 2).sum())
    rows = clustering.hierarchical_segments(matrix, 3, leaves=40).orderBy("k").collect()
    labels = np.array([r["cluster_hierarch"] for r in rows]).reshape(3, 400)
    assert len(rows) == len(points) and (labels == labels[:, :1]).all() and set(labels[:, 0]) == {0, 1, 2}
    assert isinstance(rows[0]["features"], type(Vectors.dense([0.0]))) and rows[0]["k"] == 0


def test_empty_frame_has_no_hierarchy(spark):
    matrix = frame(spark, np.zeros((1, 2)))
    assert ward.Ward(matrix).linkage().count() == 0
    assert clustering.hierarchical_segments(matrix, 3).first()["cluster_hierarch"] == 0
    assert clustering.hierarchical_segments(matrix.limit(0), 3).count() == 0
