"""Top-K selection: global, per group, and source budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .scoring import topk_score


def rank_top(scored: DataFrame, k: int, score: str = "topk_score", key: str = "product_id") -> DataFrame:
    """The k best rows with ``rank``; ties go to the smaller key.

    ``orderBy.limit`` keeps k rows per task, so the ranking window sees k rows.
    """
    order = [F.col(score).desc(), F.col(key)]
    best = scored.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def rank_top_by(scored: DataFrame, group: str, k: int, rank: str,
                score: str = "topk_score", key: str = "product_id") -> DataFrame:
    """The k best rows of each group; each task forwards at most k rows per group."""
    window = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(key))
    return scored.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def select_top_k(df: DataFrame, k: int = 20, weights: dict | None = None) -> DataFrame:
    return rank_top(topk_score(df, weights), k)


def select_top_k_by_category(df: DataFrame, k: int = 5, weights: dict | None = None) -> DataFrame:
    return rank_top_by(topk_score(df, weights), "categorie", k, "rank_in_category")


def select_top_k_by_shop(df: DataFrame, k: int = 3, weights: dict | None = None) -> DataFrame:
    return rank_top_by(topk_score(df, weights), "marque_vendeur", k, "rank_in_shop")


def source_budget(counts: DataFrame, budget: int, source: str = "store", order: str = "cat_ord",
                  size: str = "n") -> DataFrame:
    """Categories of each source visited until the running product count reaches the budget.

    The category in which the budget is reached is still taken. ``counts`` has
    one row per source and category.
    """
    before = Window.partitionBy(source).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.sum(size).over(before), F.lit(0))
    return counts.withColumn("seen_before", seen).where(F.col("seen_before") < budget)
