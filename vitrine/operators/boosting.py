"""Second-order boosted trees for a 0/1 label, grown level by level from gradient histograms.

Features are cut at exact quantiles into at most 256 bins and rows are packed into blocks of bins. A level of a tree is
one job: every block adds the gradients and hessians of its rows into a histogram for the lighter child of each node above, the
histograms are summed as a tree, the other child is the difference to the node above, and the driver, which sees nothing but them, picks the splits. Leaf weights are -G / (H + l2) and a
split needs ``min_child_weight`` of hessian on both sides.

Several models over the same rows grow in lockstep: a row has one training weight for each model (0 where it is held
out), and a pass over the blocks serves all models. So cross-validation costs passes of one model, not of one each.

Gradients are rounded to multiples of 2^-20 before they are summed; such sums are exact, so results depend neither on
the order of tasks nor on the number of blocks. Blocks of at most ``SMALL_BYTES`` in all go to one task for each model,
which does all rounds there and finds the same trees, as a job for each level would take longer than its work. Above,
margins of rows live in the blocks, in executor storage, and are written to the checkpoint folder every ``CUT_EVERY``
rounds, so a lost executor repeats a few rounds for its blocks.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from ..session import shared_dir, store_table
from . import boosting_tasks as tasks
from .boosting_tasks import Settings, Tree
from .ordering import value_ranks

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

BINS = 256
BLOCK_ROWS = 8192
PART_ROWS = 65536        # rows of a partition at most, in blocks; a job for each level costs by its partitions
SMALL_BYTES = 8 << 20    # blocks whose rounds one task does in a minute or two; then each model is one task
DIRECT = 32              # parts whose histograms the driver adds without a stage between
CUT_EVERY = 20


@dataclass
class Forest:
    """The trees of one boosted model."""

    names: list[str]
    settings: Settings
    trees: list[Tree] = field(default_factory=list)

    def margins(self, values: np.ndarray) -> np.ndarray:
        """Margin of each row of ``values`` (rows x features)."""
        columns, out = np.ascontiguousarray(values.T), np.zeros(len(values))
        for tree in self.trees:
            out += tree.leaf[tree.nodes(columns, tree.threshold, self.settings.depth)]
        return out

    def importances(self) -> np.ndarray:
        """Mean gain of the splits on each feature, as shares of their sum."""
        total, count = np.zeros(len(self.names)), np.zeros(len(self.names))
        for tree in self.trees:
            used = tree.feature >= 0
            np.add.at(total, tree.feature[used], tree.gain[used])
            np.add.at(count, tree.feature[used], 1)
        mean = total / np.maximum(count, 1)
        return mean / mean.sum() if mean.sum() > 0 else mean

    def to_json(self) -> dict:
        return {"names": self.names, "settings": vars(self.settings),
                "trees": [{k: v.tolist() for k, v in vars(t).items()} for t in self.trees]}

    @classmethod
    def from_json(cls, kept: dict) -> Forest:
        kinds = {"feature": np.int16, "cut": np.int16}
        return cls(kept["names"], Settings(**kept["settings"]),
                   [Tree(**{k: np.array(v, kinds.get(k, float)) for k, v in t.items()}) for t in kept["trees"]])


def bin_cuts(df: DataFrame, names: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper values of the bins of each column: all distinct values, or those in which an exact quantile falls."""
    ranks = value_ranks(df, names)
    distinct = {r["column"]: r["count"] for r in ranks.groupBy("column").count().collect()}
    few = [c for c, n in distinct.items() if n <= bins]
    crosses = F.floor(F.col("n_upto") * bins / F.col("n_all")) > F.floor(F.col("n_before") * bins / F.col("n_all"))
    # At most ``bins`` values of a column survive.
    kept = ranks.where(F.col("value").isNotNull() & (F.col("column").isin(few) | crosses)).select("column", "value").collect()
    return [np.array(sorted(r["value"] for r in kept if r["column"] == name)) for name in names]


def fit_lockstep(df: DataFrame, names: list[str], weights: str = "weights", label: str = "label", models: int = 1,
                 settings: Settings | None = None, bins: int = BINS) -> list[Forest]:
    """One model for each entry of the array column ``weights``, trained on the rows where that entry is above 0.

    ``names`` are numeric columns without nulls, ``label`` is 0 or 1. Cuts come from all rows that any model trains on.
    A model without rows has trees of weight 0. Without any row there are no trees.
    """
    s, spark = settings or Settings(), df.sparkSession
    used = df.where(F.exists(weights, lambda w: w > 0))
    rows = store_table(used.select(*[F.col(n).cast("double").alias(f"f{i}") for i, n in enumerate(names)],
                                   F.col(weights).alias("weights"), F.col(label).cast("double").alias("label")), "boosting")
    cuts = bin_cuts(rows, [f"f{i}" for i in range(len(names))], bins)
    sizes = np.array([max(len(c), 1) for c in cuts])
    count = rows.count()
    parts = max(1, min(-(-count // BLOCK_ROWS), max(DIRECT, -(-count // PART_ROWS))))
    packed = store_table(rows.repartition(parts).mapInArrow(tasks.pack(cuts, models, BLOCK_ROWS), "bins binary, weights binary, labels binary"), "blocks")
    sized = packed.agg(F.sum(F.octet_length("bins") + F.octet_length("weights") + F.octet_length("labels"))).first()[0] or 0
    if sized <= SMALL_BYTES:
        each = packed.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(models - 1))))
        found = each.groupBy("model").applyInArrow(tasks.train_here(s, cuts, models), "model int, trees string").collect()
        return [Forest.from_json({"names": names, "settings": vars(s), "trees": json.loads(r["trees"])})
                for r in sorted(found, key=lambda r: r["model"])] or [Forest(names, s) for _ in range(models)]
    shared_dir(spark)  # checkpoints of margins go there
    blocks = packed.rdd.map(tasks.opened(len(names), models)).persist(StorageLevel.MEMORY_AND_DISK)
    out = [Forest(names, s) for _ in range(models)]
    before, depth = None, 1 if blocks.getNumPartitions() <= DIRECT else 2
    for done in range(1, s.rounds + 1):
        trees, above = [Tree.empty(s.depth) for _ in range(models)], None
        for level in range(s.depth):
            sides = tasks.lighter(trees, level, above, sizes)
            task = tasks.histograms(*tasks.parts(trees, "feature", "cut"), level, sizes, sides)
            above = tasks.both_children(blocks.mapPartitions(task).treeReduce(np.add, depth), above, sides)
            tasks.next_level(trees, level, above, cuts, s)
            if before is not None:
                before.unpersist()
                before = None
        for forest, tree in zip(out, trees, strict=True):
            forest.trees.append(tree)
        if done < s.rounds:
            grown = tasks.advanced(*tasks.parts(trees, "feature", "cut", "leaf"), s.depth)
            before, blocks = blocks, blocks.map(grown).persist(StorageLevel.MEMORY_AND_DISK)
            if done % CUT_EVERY == 0:
                blocks.checkpoint()
    blocks.unpersist()
    return out


class _Columns(HasFeaturesCol, HasLabelCol, HasWeightCol):
    """Column names shared by the estimator and its model."""


class BoostedTrees(Estimator, _Columns, MLReadable, MLWritable):
    """Estimator of second-order boosted trees over a ``features`` vector, with a row weight if ``weightCol`` is set."""

    rounds = Param(Params._dummy(), "rounds", "boosting rounds", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of splits", TypeConverters.toInt)
    step = Param(Params._dummy(), "step", "share of a leaf weight that counts", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "penalty on leaf weights", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least hessian of a child", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, rounds: int = 200, depth: int = 5, step: float = 0.05, l2: float = 1.0,
                 minChildWeight: float = 1.0, featuresCol: str = "features", labelCol: str = "label", weightCol: str | None = None):
        super().__init__()
        self._setDefault(rounds=200, depth=5, step=0.05, l2=1.0, minChildWeight=1.0, featuresCol="features", labelCol="label")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def settings(self) -> Settings:
        get = self.getOrDefault
        return Settings(get(self.rounds), get(self.depth), get(self.step), get(self.l2), get(self.minChildWeight))

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet(self.weightCol) else F.lit(1.0)
        spread, names = _spread(df, self.getFeaturesCol(), [F.array(weight).alias("weights"), F.col(self.getLabelCol()).alias("label")])
        forest = fit_lockstep(spread, names, settings=self.settings())[0]
        return self._copyValues(BoostedTreesModel(forest))

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


def _spread(df: DataFrame, features: str, others: list) -> tuple[DataFrame, list[str]]:
    """Vector entries as columns, named by the vector's metadata where it has some."""
    first = df.select(features).first()
    names = [f"x{i}" for i in range(len(first[0]))] if first else []
    x = vector_to_array(features)
    return df.select(*[x[i].alias(n) for i, n in enumerate(names)], *others), names


class BoostedTreesModel(Model, _Columns, MLReadable, MLWritable):
    """Adds ``probability`` (vector of both classes) and ``prediction``."""

    def __init__(self, forest: Forest | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self.forest = forest

    @property
    def featureImportances(self):
        from pyspark.ml.linalg import Vectors
        return Vectors.dense(self.forest.importances())

    def _transform(self, df: DataFrame) -> DataFrame:
        p = _probabilities([self.forest])(vector_to_array(self.getFeaturesCol()))[0]
        scored = df.withColumn("probability", array_to_vector(F.array(1 - p, p)))
        return scored.withColumn("prediction", (vector_to_array("probability")[1] > 0.5).cast("double"))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: BoostedTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"forest": self.model.forest.to_json()})


class _ModelReader(MLReader):
    def load(self, path: str) -> BoostedTreesModel:
        kept = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = BoostedTreesModel(Forest.from_json(kept["forest"]))
        model._resetUid(kept["uid"])
        DefaultParamsReader.getAndSetParams(model, kept)
        return model


def _probabilities(forests: list[Forest]):
    """Arrow function: array of values to the class-1 probability by each model."""
    @F.pandas_udf("array<double>")
    def run(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=object)
        matrix = np.stack(values.to_numpy())
        return pd.Series(list(np.stack([1 / (1 + np.exp(-f.margins(matrix))) for f in forests], axis=1)))

    return run


def held_out_scores(df: DataFrame, forests: list[Forest], fold: str, names: list[str]) -> DataFrame:
    """Rows with ``prob`` by the model of their fold, and ``pred``."""
    scores = _probabilities(forests)(F.array(*[F.col(n).cast("double") for n in names]))
    return df.withColumn("prob", F.element_at(scores, F.col(fold) + 1)).withColumn("pred", (F.col("prob") > 0.5).cast("int"))
