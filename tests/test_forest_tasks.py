"""Trees of a forest that grow in one task each."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vitrine.operators import classify, forest_tasks as tasks, grouped_forest, splits
from vitrine.operators.features import assemble


def plain_split(bins, w, y, chosen):
    """Best (gain, feature, cut) by trying every cut."""
    def gini(rows):
        shares = np.array([w[rows & (y == k)].sum() for k in (0, 1)]) / w[rows].sum()
        return 1 - (shares ** 2).sum()

    every, best = np.ones(len(y), bool), (0.0, -1, 0)
    for f in chosen:
        for cut in range(bins[:, f].max()):
            left = bins[:, f] <= cut
            if left.any() and not left.all():
                gain = gini(every) - (w[left].sum() * gini(left) + w[~left].sum() * gini(~left)) / w.sum()
                if gain > best[0] + 1e-12:
                    best = (gain, f, cut)
    return best


def test_splits_equal_plain_ones_and_sibling_leaves_differ():
    rng = np.random.default_rng(2)
    bins, w = rng.integers(0, 6, (300, 4)).astype(np.int8), rng.choice([0.7, 1.6], 300)
    y = ((bins[:, 0] + bins[:, 2]) >= 5).astype(np.int8)
    node = rng.integers(0, 2, 300)
    chosen = np.array([[2, 0, 1], [3, 1, 0]])
    whole = np.bincount(2 * node + y, w, minlength=4).reshape(2, 2)
    gain, feature, cut = tasks.best_splits(bins.ravel(), 4, 6, np.arange(300), w, y.astype(np.int64), node, chosen, whole)
    for k in (0, 1):
        want = plain_split(bins[node == k], w[node == k], y[node == k], chosen[k])
        assert (gain[k], feature[k], cut[k]) == (pytest.approx(want[0]), want[1], want[2])
    data = tasks.Rows(bins, y, w)
    tree = tasks.grow(data, w, 6, 30, 2, (1, 0))
    inner = tree.feature >= 0
    assert (tree.left[inner] > np.flatnonzero(inner)).all() and ((tree.shares(bins) > 0.5) == y).mean() > 0.95
    kids = tree.left[inner]
    assert np.allclose(tree.stats[inner], tree.stats[kids] + tree.stats[kids + 1])
    says = tree.stats.argmax(axis=1)
    assert not ((~inner[kids]) & (~inner[kids + 1]) & (says[kids] == says[kids + 1])).any()
    assert (tasks.grow(data, w, 6, 2, 2, (1, 0)).feature >= 0).sum() <= 3


def frame(spark):
    return spark.range(400).select(
        F.col("id").alias("product_id"), (F.col("id") % 17).cast("double").alias("prix"), (F.col("id") % 5).cast("double").alias("rating"),
        ((F.col("id") % 17 + 3 * (F.col("id") % 5)) >= 14).cast("int").alias("top_produit"))


def test_forest_of_tasks_scores_as_its_trees_and_as_saved(spark, monkeypatch, tmp_path):
    """Spark grew the trees level by level, one job for each: a forest over 16,000 rows took as long as 1000 such trees in tasks."""
    monkeypatch.setattr(grouped_forest, "LEAST_ROWS", 100)
    monkeypatch.setattr(grouped_forest, "GROUP_NODES", 60)
    trained, row, names = classify.train_random_forest(frame(spark), trees=7, depth=8)
    assert row.first()["accuracy"] > 0.9
    stage = trained.model.stages[0]
    groups = [RandomForestClassificationModel.load(path) for path in stage.paths]
    trees = [tree for group in groups for tree in group.trees]
    assert len(trees) == 7 and len(groups) > 1 and max(tree.depth for tree in trees) <= 8
    rows = trained.predictions.collect()
    for r in rows[:10]:
        votes = sum(tree.predictProbability(r["features"]).toArray() for tree in trees)
        assert abs(votes[1] / votes.sum() - r["prob"]) < 1e-9 and r["pred"] == int(votes[1] > votes[0])
    share = sum(tree.featureImportances.toArray() for tree in trees)
    assert share / share.sum() == pytest.approx(stage.featureImportances.toArray())
    again = classify.load_model(classify.save_model(trained.model, str(tmp_path / "model")))
    same = classify.score(again, trained.test).select("product_id", "pred", "prob")
    assert sorted(same.collect()) == sorted(trained.predictions.select("product_id", "pred", "prob").collect())


def test_saved_nodes_reach_the_leaves_of_the_grown_tree(spark, monkeypatch):
    monkeypatch.setattr(grouped_forest, "LEAST_ROWS", 100)
    rows = assemble(splits.with_balanced_weight(frame(spark).withColumn("label", F.col("top_produit").cast("double")), "label"), ["prix", "rating"])
    sent, cuts = grouped_forest._sent(classify.random_forest(), rows, [F.col("weight")])
    data = sent.value
    model = grouped_forest.fit(classify.random_forest(3, 6), rows)
    bins = max(len(c) for c in cuts)
    votes = sum(tasks.grow(data, data.weights, bins, 6, 2, (42, k)).shares(data.bins) for k in range(3))
    values = sorted((cuts[0][b[0]], cuts[1][b[1]], v) for b, v in zip(data.bins, votes))
    x = vector_to_array("features")
    got = model.transform(rows).select(x[0], x[1], vector_to_array("rawPrediction")[1]).collect()
    assert isinstance(model, RandomForestClassificationModel) and np.allclose(sorted(map(tuple, got)), values)


def test_folds_vote_in_the_tasks_that_grow_the_trees(spark, monkeypatch):
    def refuse(self, rows):
        raise AssertionError("a fold's forest is fitted on the cluster")

    monkeypatch.setattr(grouped_forest, "LEAST_ROWS", 100)
    monkeypatch.setattr(RandomForestClassifier, "_fit", refuse)
    row = classify.cross_validated_f1(frame(spark), classify.random_forest(8, 8), folds=4).first()
    assert row["cv_f1_mean"] > 0.9 and 0 <= row["cv_f1_std"] < 0.1
