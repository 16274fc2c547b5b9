"""Stratified splits, folds and class weights without per-class windows.

A class may hold almost all rows, so no window is partitioned by class. The
(class, hash, key) triples are ordered globally, the few rows that start a new
part are picked, and every row compares its own (hash, key) with them.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.noise import hash52
from .ordering import row_positions
from .scaling import attach


def _part(df: DataFrame, label: str, key: str, seed: str, cuts: list[Fraction]) -> tuple[DataFrame, Column]:
    """The frame with its cut rows attached, and the number of cuts at or before each row."""
    triples = df.select(F.col(label).alias("class"), hash52(seed, F.col(key)).alias("hash"), F.col(key).alias("key"))
    ranked = row_positions(triples, ["class"], ["hash", "key"], "pos")
    starts = F.lit(False)
    for cut in cuts:
        reached = F.col("pos") * cut.denominator >= F.col("pos_of") * cut.numerator
        previous = (F.col("pos") - 1) * cut.denominator < F.col("pos_of") * cut.numerator
        starts = starts | (reached & previous)
    # At most len(cuts) rows per class; classes are few by nature.
    per_class = ranked.where(starts).groupBy("class").agg(
        F.collect_list(F.struct("hash", "key")).alias("starts"))
    record = per_class.agg(F.map_from_entries(F.collect_list(F.struct("class", "starts")))).scalar()
    own = F.struct(hash52(seed, F.col(key)).alias("hash"), F.col(key).alias("key"))
    marks = F.coalesce(F.try_element_at(F.col("starts__"), F.col(label)),
                       F.array().cast(f"array<struct<hash:bigint,key:{df.schema[key].dataType.simpleString()}>>"))
    passed = F.size(F.filter(marks, lambda s: s <= own))
    return attach(df, record, "starts__"), passed


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``: the first ``test_size`` of every class in hash order."""
    cut = Fraction(test_size).limit_denominator(1_000_000)
    marked, passed = _part(df, label, key, str(seed), [cut])
    return marked.withColumn("is_test", (passed == 0).cast("int")).drop("starts__")


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold``: equal consecutive parts of every class in hash order."""
    marked, passed = _part(df, label, key, str(seed), [Fraction(i, folds) for i in range(1, folds)])
    return marked.withColumn("fold", passed.cast("int")).drop("starts__")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: rows, balanced weight n / (classes * rows), and neg / pos."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(
        F.sum("n").alias("all"), F.count("*").alias("classes"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("neg"),
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("pos")).alias("t")).scalar()
    t = F.col("totals__")
    return attach(counts, totals, "totals__").select(
        "label", "n", (t["all"] / (t["classes"] * F.col("n"))).alias("balanced"),
        F.try_divide(t["neg"].cast("double"), t["pos"].cast("double")).alias("scale_pos_weight"))


def with_balanced_weight(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Add the balanced class weight of a 0/1 label as one conditional expression."""
    facts = df.agg(F.struct(F.count("*").alias("n"), F.sum((F.col(label) == 1).cast("long")).alias("pos")).alias("f")).scalar()
    f = F.col("facts__")
    members = F.when(F.col(label) == 1, f["pos"]).otherwise(f["n"] - f["pos"])
    return attach(df, facts, "facts__").withColumn(output, f["n"] / (2.0 * members)).drop("facts__")


def with_positive_weight(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Add weight neg / pos for positives, 1 for negatives."""
    facts = df.agg(F.struct(F.count("*").alias("n"), F.sum((F.col(label) == 1).cast("long")).alias("pos")).alias("f")).scalar()
    f = F.col("facts__")
    ratio = F.coalesce(F.try_divide((f["n"] - f["pos"]).cast("double"), f["pos"].cast("double")), F.lit(1.0))
    weighted = F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0))
    return attach(df, facts, "facts__").withColumn(output, weighted).drop("facts__")
