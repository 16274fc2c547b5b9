"""Random forests whose trees grow in tasks, or in groups, so that the driver holds one group at a time.

From ``LEAST_ROWS`` training rows on, as long as their bins take at most ``MOST_BYTES``, each tree grows in one task that holds
the bins of all rows (``forest_tasks``): a job for each level of the trees costs many times their work. Nodes go straight to
the shared folder, in groups of trees saved as Spark saves a forest, and cross-validation only adds up votes for held-out rows.

Else Spark grows the forest. While it grows, the driver keeps the nodes of all its trees, and those grow with the training rows. Up to
``TREE_ROWS`` trees times rows the forest is fitted as a whole; above, it is fitted as several forests of fewer trees on the
same rows, each with a seed of its own, and every one is saved to the shared folder before the next one starts. All trees
are there, each grown to the end on all rows; only the random numbers differ from those of one large fit.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from ..session import drop_replaced, scratch_path, store_table
from . import boosting, forest_tasks as tasks

TREE_ROWS = 24_000_000   # trees times training rows in a group
SEED_STEP = 1_000_003    # seeds of groups; the sampler adds the partition's number to a seed
LEAST_ROWS = 10_000      # training rows from which a tree grows in one task
MOST_BYTES = 256 << 20   # bins, labels and weights of all rows, which each such task holds
TREES_A_TASK = 5
GROUP_NODES = 400_000    # nodes of a group of trees that grew in tasks; the driver loads one group at a time
GROWN = {"impurity": "gini", "subsamplingRate": 1.0, "minInstancesPerNode": 1, "minInfoGain": 0.0,
         "minWeightFractionPerNode": 0.0, "bootstrap": True, "featureSubsetStrategy": "sqrt"}
NODES = ("tree long, id long, feature long, threshold double, leftChild long, n0 double, n1 double, copies long, "
         "impurity double, gain double")


def grows_in_tasks(estimator, rows: DataFrame, count: int | None = None) -> bool:
    """Whether trees of ``estimator`` over ``rows`` grow in one task each: settings, both classes, and size of the rows."""
    if type(estimator) is not RandomForestClassifier or estimator.getMaxBins() > 128 or any(
            estimator.getOrDefault(name) != value for name, value in GROWN.items()) or estimator.isSet("thresholds"):
        return False
    if count is not None and count < LEAST_ROWS:
        return False
    label = F.col(estimator.getLabelCol())
    seen = rows.agg(F.count("*"), F.count_if(label == 0), F.count_if(label == 1)).first()
    first = rows.select(estimator.getFeaturesCol()).first()
    return seen[0] >= LEAST_ROWS and seen[1] + seen[2] == seen[0] and min(seen[1:]) > 0 and seen[0] * (first[0].size + 10) <= MOST_BYTES


def _sent(estimator: RandomForestClassifier, rows: DataFrame, others: list):
    """Broadcast bins, labels and ``others`` of all rows, and the cuts: exact quantiles of all rows."""
    label = F.col(estimator.getLabelCol()).cast("byte").alias("label")
    spread, _ = boosting._spread(rows, estimator.getFeaturesCol(), [label, *others])
    spread = store_table(spread, "forest_rows")
    names = [c for c in spread.columns if c[0] == "x"]
    cuts = boosting.bin_cuts(spread.select(*[F.col(n) for n in names]), names, estimator.getMaxBins())
    fields = [f"b{n[1:]} byte" for n in names] + [f"{f.name} {f.dataType.simpleString()}" for f in spread.schema if f.name not in names]
    packed = spread.mapInArrow(lambda batches, binned=tasks.binned: binned(batches, cuts), ", ".join(fields))
    # Draws go by the place of a row, and equal rows are as good as each other.
    table = packed.orderBy(F.xxhash64(*packed.columns), *packed.columns).toArrow()
    held = {name: table.column(name).to_numpy() for name in table.column_names}
    data = tasks.Rows(np.column_stack([held[f"b{n[1:]}"] for n in names]), held["label"],
                      held.get("weight", np.zeros(0)), held.get("fold"))
    return rows.sparkSession.sparkContext.broadcast(data), cuts


def _fit_in_tasks(estimator: RandomForestClassifier, rows: DataFrame) -> Model:
    spark, trees = rows.sparkSession, estimator.getNumTrees()
    weight = F.col(estimator.getWeightCol()).cast("double") if estimator.isSet("weightCol") else F.lit(1.0)
    sent, cuts = _sent(estimator, rows, [weight.alias("weight")])
    features, bins, depth, seed = len(cuts), max(len(c) for c in cuts), estimator.getMaxDepth(), estimator.getSeed()
    subset, grow, node_rows = math.ceil(math.sqrt(features)), tasks.grow, tasks.node_rows

    def run(batches):
        for batch in batches:
            for number in batch.column("id").to_pylist():
                yield node_rows(number, grow(sent.value, sent.value.weights, bins, depth, subset, (seed, number)), cuts)

    numbers = spark.range(0, trees, 1, math.ceil(trees / TREES_A_TASK))
    nodes = store_table(numbers.mapInArrow(run, NODES), "nodes")
    sent.destroy()
    gains = nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * (F.col("n0") + F.col("n1"))).alias("gain"))
    importances = np.zeros((trees, features))
    for row in gains.collect():     # one row per tree and feature
        importances[row["tree"], row["feature"]] = row["gain"]
    total = importances.sum(axis=1, keepdims=True)
    importances = np.divide(importances, total, out=np.zeros_like(importances), where=total > 0).sum(axis=0)
    groups, room = [], 0
    for row in nodes.groupBy("tree").count().orderBy("tree").collect():
        if not groups or room + row["count"] > GROUP_NODES:
            groups, room = [*groups, []], 0
        groups[-1].append(row["tree"])
        room += row["count"]
    home = scratch_path(spark, "forest")
    paths = [_save_grown(estimator, nodes.where(F.col("tree").between(g[0], g[-1])), g[0], len(g), features, f"{home}/{i}")
             for i, g in enumerate(groups)]
    if len(paths) == 1:
        return RandomForestClassificationModel.load(paths[0])
    return GroupedForestModel(paths, importances / max(importances.sum(), 1.0e-300), estimator.getFeaturesCol())


def _save_grown(estimator: RandomForestClassifier, nodes: DataFrame, first: int, trees: int, features: int, path: str) -> str:
    """Save trees that grew in tasks as Spark saves a forest: a forest of two rows, with its nodes replaced."""
    two = nodes.sparkSession.createDataFrame([(Vectors.dense([float(y)] * features), float(y), 1.0) for y in (0, 1)],
                                             [estimator.getFeaturesCol(), estimator.getLabelCol(), "weight"]).coalesce(1)
    extra = {estimator.numTrees: trees} | ({estimator.weightCol: "weight"} if estimator.isSet("weightCol") else {})
    estimator.copy(extra).fit(two).write().save(path)
    leaf = F.col("feature") < 0
    whole = {c: F.col(c).cast("int") for c in ("id", "leftChild", "feature")}
    threshold = F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("threshold"))
    split = F.struct(whole["feature"].alias("featureIndex"), threshold.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    node = F.struct(whole["id"].alias("id"), (F.col("n1") > F.col("n0")).cast("double").alias("prediction"), "impurity",
                    F.array("n0", "n1").alias("impurityStats"), F.col("copies").alias("rawCount"), "gain", whole["leftChild"].alias("leftChild"),
                    F.when(leaf, -1).otherwise(whole["leftChild"] + 1).alias("rightChild"), split.alias("split"))
    nodes.select((F.col("tree") - first).cast("int").alias("treeID"), node.alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    return path


def held_out_counts(estimator: RandomForestClassifier, rows: DataFrame, weigh, folds: int) -> DataFrame:
    """``fold``, ``y`` and ``pred`` of each row, by a forest that grew on the rows of the other folds."""
    spark, trees, label = rows.sparkSession, estimator.getNumTrees(), estimator.getLabelCol()
    weights = []
    for fold in range(folds):       # two rows per fold
        own = weigh(rows.where(F.col("fold") != fold), label).groupBy(label).agg(F.max("weight").alias("weight")).collect()
        weights.append({int(r[label]): r["weight"] for r in own})
    sent, cuts = _sent(estimator, rows, [F.col("fold").cast("int").alias("fold")])
    features, bins, depth, seed = len(cuts), max(len(c) for c in cuts), estimator.getMaxDepth(), estimator.getSeed()
    subset, votes, vote, piece = math.ceil(math.sqrt(features)), tasks.summed_votes, tasks.VOTE, tasks.PIECE

    def grown(unit):
        fold, numbers = unit
        data = sent.value
        table = np.array([weights[fold].get(y, 0.0) for y in (0, 1)])
        own = np.where(data.fold != fold, table[data.labels], 0.0)
        return votes(data, fold, own, numbers, bins, depth, subset, seed)

    def counted(part):
        (fold, number), total = part
        y = sent.value.labels[sent.value.fold == fold][number * piece:(number + 1) * piece]
        pred = 2 * total > trees * vote
        return [(fold, a, b, int(((y == a) & (pred == b)).sum())) for a in (0, 1) for b in (0, 1)]

    units = [(fold, range(at, min(at + TREES_A_TASK, trees))) for at in range(0, trees, TREES_A_TASK) for fold in range(folds)]
    context = spark.sparkContext
    summed = context.parallelize(units, len(units)).flatMap(grown).reduceByKey(np.add, 4 * folds)
    counts = summed.flatMap(counted).collect()     # four rows per piece
    sent.destroy()
    table = spark.createDataFrame(counts, "fold int, y int, pred int, n int")
    return table.select("fold", "y", "pred", F.explode(F.array_repeat(F.lit(1), F.col("n")))).drop("col")


def fit(estimator: RandomForestClassifier, rows: DataFrame) -> Model:
    """A forest fitted as a whole, or a ``GroupedForestModel`` where its trees and the rows are many."""
    trees, count = estimator.getNumTrees(), rows.count()
    if grows_in_tasks(estimator, rows, count):
        return _fit_in_tasks(estimator, rows)
    groups = math.ceil(trees / max(1, TREE_ROWS // max(1, count)))
    if groups <= 1:
        return estimator.fit(rows)
    home, paths, importances = scratch_path(rows.sparkSession, "forest"), [], 0.0
    for group in range(groups):
        own = trees * (group + 1) // groups - trees * group // groups
        model = estimator.copy({estimator.numTrees: own, estimator.seed: estimator.getSeed() + SEED_STEP * group}).fit(rows)
        # Importances are shares of one tree, averaged over the trees that split at all.
        importances = importances + model.featureImportances.toArray() * sum(tree.numNodes > 1 for tree in model.trees)
        paths.append(f"{home}/{group}")
        model.write().save(paths[-1])
    return GroupedForestModel(paths, importances / max(importances.sum(), 1.0), estimator.getFeaturesCol())


class GroupedForestModel(Model, MLReadable, MLWritable):
    """Adds ``rawPrediction``, ``probability`` and ``prediction``, as the forest of all trees would.

    ``paths`` are saved forests. Their votes are added up one forest after the other; rows with the votes so far are stored
    in between, so neither the driver nor a task holds more than one of the forests. So ``transform`` runs jobs.
    """

    def __init__(self, paths: list[str], importances: np.ndarray, features: str = "features"):
        super().__init__()
        self.paths, self.importances, self.features = paths, np.asarray(importances, float), features

    @property
    def featureImportances(self):
        return Vectors.dense(self.importances)

    def _transform(self, df: DataFrame) -> DataFrame:
        rows = df
        for path in self.paths:
            own = vector_to_array("rawPrediction")
            votes = F.zip_with("votes__", own, lambda a, b: a + b) if "votes__" in rows.columns else own
            voted = RandomForestClassificationModel.load(path).transform(rows).withColumn("votes__", votes)
            stored = store_table(voted.drop("rawPrediction", "probability", "prediction"), "votes")
            if rows is not df:
                drop_replaced(rows, stored)
            rows = stored
        total = F.aggregate("votes__", F.lit(0.0), lambda a, x: a + x)
        share = F.transform("votes__", lambda v: F.coalesce(F.try_divide(v, total), F.lit(0.0)))
        return rows.withColumns({
            "rawPrediction": array_to_vector("votes__"), "probability": array_to_vector(share),
            "prediction": (F.array_position("votes__", F.array_max("votes__")) - 1).cast("double")}).drop("votes__")

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: GroupedForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        kept = {"groups": len(self.model.paths), "importances": self.model.importances.tolist(), "features": self.model.features}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, kept)
        for group, source in enumerate(self.model.paths):
            RandomForestClassificationModel.load(source).write().save(f"{path}/groups/{group}")


class _ModelReader(MLReader):
    def load(self, path: str) -> GroupedForestModel:
        kept = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = GroupedForestModel([f"{path}/groups/{group}" for group in range(kept["groups"])], kept["importances"], kept["features"])
        model._resetUid(kept["uid"])
        return model
