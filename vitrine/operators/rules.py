"""Baskets, frequent itemsets and association rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.numeric import half_even
from ..session import store_table
from ..sources.tables import write_table
from .ordering import value_codes

ITEMSET_SCHEMA = "items string, size int, freq long, support double"
RULE_SCHEMA = "antecedents string, consequents string, support double, confidence double, lift double"


def build_baskets(df: DataFrame, group: str = "marque_vendeur", item: str = "categorie") -> DataFrame:
    """Sorted distinct items per group.

    A basket is bounded by the item vocabulary, not by the group's rows: the
    partial ``collect_set`` removes duplicates before the shuffle.
    """
    return df.groupBy(group).agg(F.sort_array(F.collect_set(item)).alias("items"))


def basket_onehot(df: DataFrame, group: str, item: str, vocabulary: list | None = None) -> DataFrame:
    """0/1 column per item; name the vocabulary to spare the scan that finds it."""
    marks = df.groupBy(group).pivot(item, vocabulary).agg(F.lit(1))
    return marks.fillna(0)


def basket_vectors(df: DataFrame, group: str, item: str) -> tuple[DataFrame, DataFrame]:
    """Sparse 0/1 vector ``items`` of every group, and the vocabulary (``item``, ``place``).

    For vocabularies too wide for columns: items are numbered by code point in a distributed pass, without a limit, and
    nothing but the number of items comes to the driver. A missing item adds nothing; a group of missing items only
    has an empty vector. A vector is bounded by the distinct items of its group. Vectors are written in the layout in
    which Spark keeps sparse vectors, and read back as such.
    """
    pairs = df.select(F.col(group), F.col(item).cast("string").alias("item__"))
    codes = value_codes(pairs.where(F.col("item__").isNotNull()).select(F.col("item__").alias("item")), ["item"])
    vocabulary = codes.select(F.col("value").alias("item"), F.col("code").alias("place"))
    width = vocabulary.count()
    placed = pairs.join(vocabulary, F.col("item__") == F.col("item"), "left")
    places = F.sort_array(F.collect_set("place"))
    grouped = placed.groupBy(group).agg(places.alias("places"))
    sparse = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"), F.col("places").alias("indices"),
                      F.array_repeat(F.lit(1.0), F.size("places")).alias("values"))
    schema = T.StructType([df.schema[group], T.StructField("items", VectorUDT())])
    return store_table(grouped.select(group, sparse.alias("items")), "vectors", schema), vocabulary


def _fit(baskets: DataFrame, min_support: float, min_confidence: float):
    return FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.1) -> DataFrame:
    """Itemsets with support at or above the minimum, most frequent first."""
    model = _fit(baskets, min_support, 0.0)
    total = baskets.agg(F.count("*")).scalar()
    return model.freqItemsets.select(
        F.array_join(F.sort_array("items"), ", ").alias("items"),
        F.size("items").alias("size"), "freq",
        half_even(F.col("freq") / total, 4).alias("support"),
    ).orderBy(F.col("freq").desc(), "items")


def association_rules(baskets: DataFrame, min_support: float = 0.1, min_confidence: float = 0.5,
                      min_lift: float = 1.0) -> DataFrame:
    """Rules with one consequent, filtered on unrounded values, best lift first.

    No frequent itemset or no rule gives an empty frame with the same schema.
    """
    rules = _fit(baskets, min_support, min_confidence).associationRules
    return rules.where(F.col("lift") >= min_lift).select(
        F.array_join(F.sort_array("antecedent"), ", ").alias("antecedents"),
        F.array_join(F.sort_array("consequent"), ", ").alias("consequents"),
        *[half_even(F.col(c), 4).alias(c) for c in ("support", "confidence", "lift")],
    ).orderBy(F.col("lift").desc(), "antecedents", "consequents")


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    return rules.orderBy(F.col("lift").desc(), "antecedents", "consequents").limit(n)


def run_association_analysis(df: DataFrame, group: str, item: str, min_support: float = 0.05,
                             min_confidence: float = 0.3, min_lift: float = 0.5,
                             sink: str | None = None) -> DataFrame:
    """Baskets of real groups to rules, with an optional CSV sink."""
    rules = association_rules(build_baskets(df, group, item), min_support, min_confidence, min_lift)
    return with_sink(rules, sink)


def with_sink(df: DataFrame, sink: str | None) -> DataFrame:
    """``df``, written to the CSV folder ``sink`` if one is given; it is then computed once and returned stored."""
    if not sink:
        return df
    stored = store_table(df, "sunk")
    write_table(stored, sink, "csv")
    return stored
