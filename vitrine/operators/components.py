"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or to the node itself)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(
        F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def contract(edges: DataFrame) -> tuple[DataFrame, int]:
    """Edges (a, b) turned into stars around each component's smallest id, and the rounds it took.

    Large-star and small-star alternate until the edge set stands still. Rounds grow with the logarithm of the
    component sizes, whatever the order of ids; no round has more edges than the one before. Every round is checkpointed
    to the shared folder. Minima are combined before the shuffle; adaptive execution splits the joins at hubs.
    """
    state = cut_lineage(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen, rounds = None, 0
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            return state, rounds
        seen, rounds = mark, rounds + 1
        state = cut_lineage(_small_star(_large_star(state)))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``id`` to ``comp``, the smallest id of its component."""
    stars, _ = contract(edges)
    return nodes.join(stars, nodes["id"] == stars["a"], "left").select("id", F.coalesce("b", "id").alias("comp"))
