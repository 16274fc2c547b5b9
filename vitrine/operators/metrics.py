"""Binary classification metrics over any frame of label, prediction, probability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import half_even
from .ordering import running_totals
from .scaling import attach


def _cells(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row with tn, fp, fn, tp."""
    def count(actual: int, predicted: int) -> Column:
        return F.count(F.when((F.col(y) == actual) & (F.col(pred) == predicted), 1))

    return df.agg(count(0, 0).alias("tn"), count(0, 1).alias("fp"), count(1, 0).alias("fn"), count(1, 1).alias("tp"))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * p * r, p + r), F.lit(0.0))


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Dense 2 x 2 counts: ``actual``, ``predicted``, ``n``."""
    cells = _cells(df, y, pred)
    rows = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
                     for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return cells.select(F.explode(rows).alias("cell")).select("cell.*")


def binary_metrics(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; an empty ratio is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    ratios = _cells(df, y, pred).select(
        _share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"), _share(tp, tp + fn).alias("recall"))
    full = ratios.withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    return full.select(*[half_even(F.col(c), 6).alias(c) for c in full.columns])


def class_report(df: DataFrame, y: str = "y", pred: str = "pred",
                 names: tuple[str, str] = ("Non-Top", "Top")) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    per = _cells(df, y, pred).select(
        _share(tn, tn + fn).alias("p0"), _share(tn, tn + fp).alias("r0"), (tn + fp).alias("s0"),
        _share(tp, tp + fp).alias("p1"), _share(tp, tp + fn).alias("r1"), (tp + fn).alias("s1"))
    per = per.withColumns({"f0": _f1(F.col("p0"), F.col("r0")), "f1": _f1(F.col("p1"), F.col("r1")),
                           "all": F.col("s0") + F.col("s1")})

    def line(name: str, pick) -> Column:
        return F.struct(F.lit(name).alias("row"), *[
            half_even(pick(m), 6).alias(n) for m, n in (("p", "precision"), ("r", "recall"), ("f", "f1"))],
            (F.col("all") if name.endswith("avg") else pick("s")).alias("support"))

    def macro(m: str) -> Column:
        return (F.col(m + "0") + F.col(m + "1")) / 2.0

    def weighted(m: str) -> Column:
        return _share(F.col(m + "0") * F.col("s0") + F.col(m + "1") * F.col("s1"), F.col("all"))

    rows = F.array(line(names[0], lambda m: F.col(m + "0")), line(names[1], lambda m: F.col(m + "1")),
                   line("macro avg", macro), line("weighted avg", weighted))
    return per.select(F.explode(rows).alias("r")).select("r.*")


def _thresholds(df: DataFrame, y: str, prob: str) -> DataFrame:
    """Running positives and negatives per distinct probability, highest first."""
    positive = F.sum((F.col(y) == 1).cast("long"))
    counts = df.groupBy(F.col(prob).alias("threshold")).agg(
        positive.alias("pos"), (F.count("*") - positive).alias("neg"))
    counts = counts.withColumn("one", F.lit(1).cast("long"))
    return running_totals(counts, [], [F.col("threshold").desc()], {"tps": "pos", "fps": "neg", "idx": "one"})


def roc_curve(df: DataFrame, y: str = "y", prob: str = "prob", drop_intermediate: bool = False) -> DataFrame:
    """ROC points per distinct threshold, plus the origin (threshold NULL).

    ``drop_intermediate`` removes points on a straight line between neighbours.
    """
    points = _thresholds(df, y, prob)
    if drop_intermediate:
        after = points.select((F.col("idx_upto") - 1).alias("at"), F.col("pos").alias("next_pos"),
                              F.col("neg").alias("next_neg"))
        points = points.join(after, F.col("idx_upto") == F.col("at"), "left").where(
            (F.col("idx_upto") == 1) | F.col("at").isNull()
            | (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg")))
    curve = points.select(
        "threshold", half_even(_share(F.col("fps_upto"), F.col("fps_all")), 6).alias("fpr"),
        half_even(_share(F.col("tps_upto"), F.col("tps_all")), 6).alias("tpr"))
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return curve.unionByName(origin)


def auc_exact(df: DataFrame, y: str = "y", prob: str = "prob") -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL for a single class."""
    points = _thresholds(df, y, prob)
    area = F.sum(F.col("neg").cast("double") * (F.col("tps_before") + F.col("pos") / 2.0))
    total = F.max(F.col("tps_all").cast("double") * F.col("fps_all"))
    return points.agg(half_even(F.try_divide(area, total), 6).alias("auc"))
