"""What a forest and its folds leave to the driver."""

import threading
import time

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import functions as F

from vitrine.operators import classify, grouped_forest
from vitrine.operators.features import assemble


def test_folds_of_a_forest_train_one_after_the_other(spark):
    """Five forests at once were five times the trees on the driver; and grown trees are not sent out at every step."""
    running, most, lock = [0], [0], threading.Lock()

    class Counted:
        def copy(self):
            return self

        def fit(self, rows):
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            time.sleep(0.3)
            model = DecisionTreeClassifier(maxDepth=1, weightCol="weight").fit(rows)
            with lock:
                running[0] -= 1
            return model

    df = spark.range(40).select(F.col("id").alias("product_id"), F.col("id").cast("double").alias("prix"),
                                (F.col("id") >= 20).cast("int").alias("top_produit"))
    row = classify.cross_validated_f1(df, Counted(), folds=3).first()
    assert most[0] == 1 and 0 < row["cv_f1_mean"] <= 1
    assert classify.random_forest().getCacheNodeIds()


def test_forest_in_groups_leaves_one_group_on_the_driver(spark, monkeypatch, tmp_path):
    """200 trees were fitted and kept at once, however many the rows; a grouped forest has all trees and scores alike once saved."""
    fitted = []

    class Watched(RandomForestClassifier):
        def _fit(self, rows):
            fitted.append((self.getNumTrees(), self.getSeed()))
            return super()._fit(rows)

    monkeypatch.setattr(classify, "random_forest", lambda trees, depth: Watched(
        numTrees=trees, maxDepth=depth, seed=42, weightCol="weight", labelCol="label", featuresCol="features"))
    monkeypatch.setattr(grouped_forest, "TREE_ROWS", 500)
    df = spark.range(200).select(
        F.col("id").alias("product_id"), (F.col("id") % 17).cast("double").alias("prix"), (F.col("id") % 5).cast("double").alias("rating"),
        ((F.col("id") % 17 + 3 * (F.col("id") % 5)) >= 14).cast("int").alias("top_produit"))
    trained, row, names = classify.train_random_forest(df, trees=7, depth=8)
    assert sum(n for n, _ in fitted) == 7 and max(n for n, _ in fitted) <= 3 and len({s for _, s in fitted}) == len(fitted)
    assert row.first()["accuracy"] > 0.8
    weights = [r["importance"] for r in classify.feature_importance(spark, trained, names).collect()]
    assert abs(sum(weights) - 1) < 1e-9 and min(weights) > 0

    # Votes and importances are those of all seven trees together.
    groups = [RandomForestClassificationModel.load(path) for path in trained.model.stages[0].paths]
    trees = [tree for group in groups for tree in group.trees]
    rows = trained.predictions.collect()
    for r in rows[:10]:
        votes = sum(tree.predictProbability(r["features"]).toArray() for tree in trees)
        assert abs(votes[1] / votes.sum() - r["prob"]) < 1e-9 and r["pred"] == int(votes[1] > votes[0])
    share = sum(tree.featureImportances.toArray() for tree in trees)
    assert sorted(share / share.sum()) == pytest.approx(sorted(weights))

    path = classify.save_model(trained.model, str(tmp_path / "model"))
    again = classify.load_model(path)
    same = classify.score(again, trained.test).select("product_id", "pred", "prob")
    assert sorted(same.collect()) == sorted(trained.predictions.select("product_id", "pred", "prob").collect())
    with pytest.raises(ValueError):
        classify.save_model(again, path)


def test_small_forest_is_fitted_as_a_whole(spark):
    df = spark.range(40).select(F.col("id").cast("double").alias("x"), (F.col("id") >= 20).cast("double").alias("label"), F.lit(1.0).alias("weight"))
    model = grouped_forest.fit(classify.random_forest(3, 2), assemble(df, ["x"]))
    assert isinstance(model, RandomForestClassificationModel) and len(model.trees) == 3
