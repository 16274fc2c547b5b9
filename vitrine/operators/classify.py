"""Tree classifiers on stratified splits, with metrics, CV and importances."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numeric import half_even
from ..session import store_table
from . import boosting, grouped_forest, metrics, splits
from .boosting import BoostedTrees
from .features import assemble, model_frame


@dataclass
class Trained:
    """A fitted model, its held-out rows and their predictions."""

    model: PipelineModel
    test: DataFrame
    predictions: DataFrame


def random_forest(trees: int = 200, depth: int = 30, seed: int = 42) -> RandomForestClassifier:
    """With the nodes of rows kept beside the rows, the driver doesn't send out all grown trees at every step."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed,
                                  weightCol="weight", labelCol="label", featuresCol="features", cacheNodeIds=True)


def _fit(estimator: Estimator, rows: DataFrame):
    return grouped_forest.fit(estimator, rows) if isinstance(estimator, RandomForestClassifier) else estimator.fit(rows)


def boosted_trees(rounds: int = 200, depth: int = 5, step: float = 0.05) -> BoostedTrees:
    return BoostedTrees(rounds=rounds, depth=depth, step=step, weightCol="weight")


def _frame(df: DataFrame, preset: str, key: str) -> tuple[DataFrame, list[str]]:
    frame, names = model_frame(df, preset, key)
    return assemble(frame, names).select(key, "label", "features"), names


def score(model, rows: DataFrame) -> DataFrame:
    """Label, prediction and class-1 probability of every row."""
    return model.transform(rows).withColumns({
        "y": F.col("label").cast("int"), "pred": F.col("prediction").cast("int"),
        "prob": vector_to_array("probability")[1]})


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: accuracy, precision, recall, F1 and exact AUC."""
    area = metrics.auc_exact(predictions).scalar()
    return metrics.binary_metrics(predictions).withColumn("auc", area)


def _train(df: DataFrame, estimator: Estimator, weigh, preset: str, key: str,
           test_size: float) -> tuple[Trained, DataFrame, list[str]]:
    frame, names = _frame(df, preset, key)
    split = store_table(splits.stratified_split(frame, "label", key, test_size), "split")
    train = weigh(split.where("is_test = 0"), "label")
    test = split.where("is_test = 1").select(key, "label", "features")
    model = PipelineModel([_fit(estimator, train)])
    trained = Trained(model, test, score(model, test))
    return trained, evaluate(trained.predictions), names


def train_random_forest(df: DataFrame, test_size: float = 0.2, trees: int = 200, depth: int = 30,
                        preset: str = "classification", key: str = "product_id"):
    """Balanced random forest: (trained, one-row metrics, feature names)."""
    return _train(df, random_forest(trees, depth), splits.with_balanced_weight, preset, key, test_size)


def train_boosted_trees(df: DataFrame, test_size: float = 0.2, rounds: int = 200, depth: int = 5,
                        preset: str = "classification", key: str = "product_id", weighted: bool = True):
    """Boosted trees with positives weighted neg / pos: (trained, metrics, feature names)."""
    def unit(frame: DataFrame, label: str) -> DataFrame:
        return frame.withColumn("weight", F.lit(1.0))

    weigh = splits.with_positive_weight if weighted else unit
    return _train(df, boosted_trees(rounds, depth), weigh, preset, key, test_size)


def _folded(df: DataFrame, preset: str, key: str, folds: int) -> tuple[DataFrame, list[str]]:
    frame, names = model_frame(df, preset, key)
    return store_table(splits.stratified_folds(frame, "label", key, folds), "folds"), names


def _mean_f1(held: list[DataFrame]) -> DataFrame:
    """Mean and population deviation of the class-1 F1 of the folds' scored rows."""
    rows = None
    for part in held:
        row = metrics.binary_metrics(part).select("f1")
        rows = row if rows is None else rows.unionByName(row)
    return rows.agg(half_even(F.avg("f1"), 4).alias("cv_f1_mean"), half_even(F.stddev_pop("f1"), 4).alias("cv_f1_std"))


def cross_validated_f1(df: DataFrame, estimator: Estimator, folds: int = 5, balanced: bool = True,
                       preset: str = "classification", key: str = "product_id", parallelism: int = 1) -> DataFrame:
    """Mean and population deviation of the class-1 F1 over stratified folds.

    Every fold trains on one shared stored frame. Boosted trees of all folds grow in lockstep, a pass for all of them
    (positives weigh neg / pos). Trees of a forest that grow in one task each vote there for the rows held out. Other estimators
    train ``parallelism`` folds at a time, as many models at a time being on the driver.
    """
    folded, names = _folded(df, preset, key, folds)
    if isinstance(estimator, BoostedTrees):
        weight = splits.with_positive_weight(folded, "label")
        apart = F.array(*[F.when(F.col("fold") == fold, 0.0).otherwise(F.col("weight")) for fold in range(folds)])
        forests = boosting.fit_lockstep(weight.withColumn("weights", apart), names, models=folds, settings=estimator.settings())
        scored = store_table(boosting.held_out_scores(folded, forests, "fold", names)
                             .select("fold", F.col("label").cast("int").alias("y"), "pred"), "held")
        return _mean_f1([scored.where(F.col("fold") == fold) for fold in range(folds)])
    ready = assemble(folded, names).select(key, "label", "fold", "features")
    weigh = splits.with_balanced_weight if balanced else splits.with_positive_weight
    if grouped_forest.grows_in_tasks(estimator, ready):
        scored = store_table(grouped_forest.held_out_counts(estimator, ready, weigh, folds), "held")
        return _mean_f1([scored.where(F.col("fold") == fold) for fold in range(folds)])

    def train(fold: int) -> DataFrame:
        model = _fit(estimator.copy(), weigh(ready.where(F.col("fold") != fold), "label"))
        return store_table(score(model, ready.where(F.col("fold") == fold)).select("y", "pred"), "held")

    pool = ThreadPool(min(parallelism, folds))
    try:
        return _mean_f1(pool.map(inheritable_thread_target(train), range(folds)))
    finally:
        pool.terminate()


def feature_importance(spark: SparkSession, trained: Trained, names: list[str]) -> DataFrame:
    """Importance per feature, highest first (one value per feature)."""
    weights = trained.model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


def run_full_classification(df: DataFrame, trees: int = 200, depth: int = 30, rounds: int = 200,
                            folds: int = 5) -> dict:
    """Both models and their comparison table; ``folds=0`` skips cross-validation."""
    forest, forest_row, names = train_random_forest(df, trees=trees, depth=depth)
    boosted, boosted_row, _ = train_boosted_trees(df, rounds=rounds)
    rows = []
    for title, row, estimator, balanced in (
            ("Random Forest", forest_row, random_forest(trees, depth), True),
            ("Boosted Trees", boosted_row, boosted_trees(rounds), False)):
        row = row.select(F.lit(title).alias("model"), "*")
        if folds:
            cv = cross_validated_f1(df, estimator, folds, balanced)
            row = row.withColumn("cv_f1_mean", cv.select("cv_f1_mean").scalar())
        rows.append(row)
    return {"random_forest": forest, "boosted_trees": boosted, "features": names,
            "metrics": rows[0].unionByName(rows[1])}


def save_model(model: PipelineModel, path: str) -> str:
    """Save a model with all it needs; a model that still reads forests below ``path`` can't replace them."""
    own = [kept for stage in model.stages for kept in getattr(stage, "paths", [])]
    if any(kept.startswith(path.rstrip("/") + "/") for kept in own):
        raise ValueError(f"the model reads its trees from {path}; save it to another path")
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
