"""What tasks do for a forest over many rows: plain functions over arrays, so that a tree grows in one task.

The rows are a matrix of bins (rows x features), 0/1 labels and weights. A tree is the one Spark's forest would grow from the
same draws: Poisson(1) copies of rows, a new set of features for each node, the split of highest Gini gain among the cuts,
nodes down to pure ones or the greatest depth, and sibling leaves of one prediction merged.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

LEAST_GAIN = 1e-12       # what rounding makes of no gain stays below
VOTE = float(1 << 30)    # votes are summed as integers, so their order says nothing
PIECE = 65536            # rows of a piece of summed votes


@dataclass
class Rows:
    """Training rows; ``fold`` is that of each row, where there are folds."""

    bins: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    fold: np.ndarray | None = None


@dataclass
class Tree:
    """Nodes level by level, the root first; feature -1 is a leaf. A row goes left where its bin is at most the cut."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    stats: np.ndarray      # weight of both classes
    copies: np.ndarray     # rows with their copies
    impurity: np.ndarray
    gain: np.ndarray

    def kept(self, nodes: np.ndarray, left: np.ndarray) -> Tree:
        return Tree(self.feature[nodes], self.cut[nodes], left, self.stats[nodes], self.copies[nodes], self.impurity[nodes], self.gain[nodes])

    def importances(self, features: int) -> np.ndarray:
        split = self.feature >= 0
        total = np.bincount(self.feature[split], self.gain[split] * self.stats[split].sum(axis=1), minlength=features)
        return total / total.sum() if total.sum() > 0 else total

    def shares(self, bins: np.ndarray) -> np.ndarray:
        """Share of class 1 in the leaf of each row."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            own = self.feature[at[rows]]
            rows, own = rows[own >= 0], own[own >= 0]
            here = at[rows]
            at[rows] = self.left[here] + (bins[rows, own] > self.cut[here])
        return (self.stats[:, 1] / self.stats.sum(axis=1))[at]


def gini(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(axis=-1)
    with np.errstate(all="ignore"):
        return np.where(total > 0, 1.0 - (stats ** 2).sum(axis=-1) / total ** 2, 0.0)


def best_splits(flat: np.ndarray, features: int, bins: int, rows: np.ndarray, w: np.ndarray, y: np.ndarray, node: np.ndarray,
                chosen: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature, bin) of the best split of each node among its chosen features; the first of equal ones."""
    count = len(whole)
    best, feature, cut = np.full(count, LEAST_GAIN), np.full(count, -1), np.zeros(count, np.int64)
    at, base, total = rows * features, node * (2 * bins) + y, whole.sum(axis=1)
    for j in range(chosen.shape[1]):
        place = base + 2 * flat[at + chosen[node, j]]
        left = np.bincount(place, w, minlength=count * bins * 2).reshape(count, bins, 2).cumsum(axis=1)
        right = left[:, -1:] - left
        n_left, n_right = left.sum(axis=2), right.sum(axis=2)
        gain = gini(left[:, -1])[:, None] - (n_left * gini(left) + n_right * gini(right)) / total[:, None]
        gain = np.where((n_left > 0) & (n_right > 0), gain, -np.inf)
        where = gain.argmax(axis=1)
        top = gain[np.arange(count), where]
        better = top > best
        best[better], feature[better], cut[better] = top[better], chosen[better, j], where[better]
    return best, feature, cut


def grow(data: Rows, weights: np.ndarray, bins: int, depth: int, subset: int, seed: tuple[int, ...]) -> Tree:
    """One tree over the rows whose weight is above 0."""
    draw, features = np.random.default_rng(seed), data.bins.shape[1]
    flat = data.bins.ravel()
    copies = draw.poisson(1.0, len(data.labels))
    rows = np.flatnonzero((copies > 0) & (weights > 0))
    copies = copies[rows]
    w, y, node, levels, size = copies * weights[rows], data.labels[rows].astype(np.int64), np.zeros(len(rows), np.int64), [], 1
    for level in range(depth + 1):
        stats = np.bincount(2 * node + y, w, minlength=2 * size).reshape(size, 2)
        held = np.bincount(node, copies, minlength=size)
        impurity, feature, cut, gain = gini(stats), np.full(size, -1), np.zeros(size, np.int64), np.full(size, -1.0)
        opened = np.flatnonzero((stats > 0).all(axis=1)) if level < depth else np.zeros(0, np.int64)
        if len(opened):
            name = np.full(size, -1)
            name[opened] = np.arange(len(opened))
            stay = name[node] >= 0
            rows, w, y, copies, node = rows[stay], w[stay], y[stay], copies[stay], name[node[stay]]
            chosen = draw.random((len(opened), features)).argsort(axis=1)[:, :subset]
            gain[opened], feature[opened], cut[opened] = best_splits(flat, features, bins, rows, w, y, node, chosen, stats[opened])
        split = np.flatnonzero(feature >= 0)
        gain[feature < 0] = -1.0
        levels.append((feature, cut, stats, held, impurity, gain, split))
        if not len(split):
            break
        child = np.full(size, -1)
        child[split] = 2 * np.arange(len(split))
        own = opened[node]
        stay = child[own] >= 0
        rows, w, y, copies, own = rows[stay], w[stay], y[stay], copies[stay], own[stay]
        node = child[own] + (flat[rows * features + feature[own]] > cut[own])
        size = 2 * len(split)
    starts = np.cumsum([0, *(len(own[0]) for own in levels)])
    left = np.full(starts[-1], -1)
    for k, own in enumerate(levels):
        left[starts[k] + own[6]] = starts[k + 1] + 2 * np.arange(len(own[6]))
    tree = Tree(*(np.concatenate([own[i] for own in levels]) for i in (0, 1)), left, *(np.concatenate([own[i] for own in levels]) for i in (2, 3, 4, 5)))
    return pruned(tree, starts)


def pruned(tree: Tree, starts: np.ndarray) -> Tree:
    """Sibling leaves with one prediction become their parent."""
    ends, says = tree.feature < 0, tree.stats.argmax(axis=1)
    for low, high in zip(starts[-2::-1], starts[:0:-1]):
        own = low + np.flatnonzero(~ends[low:high])
        a = tree.left[own]
        ends[own[ends[a] & ends[a + 1] & (says[a] == says[a + 1])]] = True
    tree.feature[ends], tree.gain[ends], tree.left[ends] = -1, -1.0, -1
    there = np.zeros(len(ends), bool)
    there[0] = True
    for low, high in zip(starts[:-1], starts[1:]):
        own = low + np.flatnonzero(there[low:high] & ~ends[low:high])
        there[tree.left[own]] = there[tree.left[own] + 1] = True
    nodes = np.flatnonzero(there)
    left = tree.left[nodes]
    return tree.kept(nodes, np.where(left >= 0, np.cumsum(there)[left] - 1, -1))


def binned(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Arrow batches with the bins of x0, x1, ... as bytes b0, b1, ..., the other columns unchanged."""
    for batch in batches:
        names, columns = [], []
        for name, column in zip(batch.schema.names, batch.columns):
            if name[0] == "x" and name[1:].isdigit():
                own = cuts[int(name[1:])]
                codes = np.minimum(np.searchsorted(own, column.to_numpy(zero_copy_only=False)), max(len(own) - 1, 0))
                name, column = f"b{name[1:]}", pa.array(codes.astype(np.int8))
            names.append(name)
            columns.append(column)
        yield pa.RecordBatch.from_arrays(columns, names)


def node_rows(number: int, tree: Tree, cuts: list[np.ndarray]) -> pa.RecordBatch:
    """A tree as rows, with the fields of a node of a saved forest."""
    split = tree.feature >= 0
    value = [float(cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut)]
    columns = {"tree": np.full(len(split), number), "id": np.arange(len(split)), "feature": tree.feature, "threshold": np.array(value),
               "leftChild": tree.left, "n0": tree.stats[:, 0], "n1": tree.stats[:, 1], "copies": tree.copies.astype(np.int64),
               "impurity": tree.impurity, "gain": tree.gain}
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))


def summed_votes(data: Rows, fold: int, weights: np.ndarray, trees: range, bins: int, depth: int, subset: int, seed: int):
    """((fold, piece), votes of the trees for class 1) of the fold's rows, by trees that grow on the other rows."""
    held = np.flatnonzero(data.fold == fold)
    own, total = data.bins[held], np.zeros(len(held), np.int64)
    for number in trees:
        tree = grow(data, weights, bins, depth, subset, (seed, fold, number))
        total += np.rint(tree.shares(own) * VOTE).astype(np.int64)
    for at in range(0, len(total), PIECE):
        yield (fold, at // PIECE), total[at:at + PIECE]
