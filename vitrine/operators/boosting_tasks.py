"""What tasks do for ``boosting``: plain functions over arrays, so that a job ships little code.

A block is (bins: features x rows, weights: models x rows, labels, margins: models x rows). Trees are one array per
attribute with a row for each model and the nodes in heap order.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

UNIT = float(1 << 20)


def walk(feature: np.ndarray, cut: np.ndarray, columns: np.ndarray, levels: int) -> np.ndarray:
    """Node that each row (a column of ``columns``) has reached after ``levels`` splits at most."""
    size, flat = columns.shape[1], columns.reshape(-1)
    at, every, feature = np.zeros(size, np.int64), np.arange(size), feature.astype(np.int64)
    for _ in range(levels):
        own = feature[at]
        right = flat[np.maximum(own, 0) * size + every] > cut[at]
        at = np.where(own >= 0, 2 * at + 1 + right, at)
    return at


@dataclass
class Settings:
    """200 rounds of depth 5 with step 0.05; the rest are the learner's usual defaults."""

    rounds: int = 200
    depth: int = 5
    step: float = 0.05
    l2: float = 1.0
    min_child_weight: float = 1.0
    min_gain: float = 0.0


@dataclass
class Tree:
    """Nodes in heap order; feature -1 ends a path. A row goes left where its value is at most the threshold."""

    feature: np.ndarray
    cut: np.ndarray          # bin
    threshold: np.ndarray    # value
    leaf: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = (1 << (depth + 1)) - 1
        return cls(np.full(size, -1, np.int16), np.zeros(size, np.int16), np.zeros(size), np.zeros(size), np.zeros(size))

    def nodes(self, columns: np.ndarray, cuts: np.ndarray, levels: int) -> np.ndarray:
        """Node that each row (a column of ``columns``) has reached after ``levels`` splits at most."""
        return walk(self.feature, cuts, columns, levels)


def whole(batches: Iterator[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """A partition's rows as one batch, so that its blocks are full."""
    kept = list(batches)
    return [pa.concat_batches(kept)] if kept else []


def pack(cuts: list[np.ndarray], models: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches):
            for a in range(0, len(batch), rows):
                part = batch.slice(a, rows)
                columns = [np.searchsorted(c, part.column(f"f{i}").to_numpy(zero_copy_only=False)) for i, c in enumerate(cuts)]
                bins = np.stack([np.minimum(x, max(len(c) - 1, 0)) for x, c in zip(columns, cuts, strict=True)])
                weights = part.column("weights").flatten().to_numpy(zero_copy_only=False).reshape(len(part), models).T
                labels = part.column("label").to_numpy(zero_copy_only=False)
                values = [bins.astype(np.uint8).tobytes(), weights.astype(float).tobytes(), labels.astype(float).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], ["bins", "weights", "labels"])

    return run


def opened(features: int, models: int):
    def make(row) -> tuple:
        weights = np.frombuffer(row[1]).reshape(models, -1)
        return np.frombuffer(row[0], np.uint8).reshape(features, -1), weights, np.frombuffer(row[2]), np.zeros(weights.shape)

    return make


def gradients(weight: np.ndarray, labels: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    share = 1 / (1 + np.exp(-margin))
    g, h = weight * (share - labels), weight * np.maximum(share * (1 - share), 1e-16)
    return np.rint(g * UNIT) / UNIT, np.rint(h * UNIT) / UNIT


def histograms(feature: np.ndarray, cut: np.ndarray, level: int, sizes: np.ndarray, sides: np.ndarray | None):
    """Sums of gradients and hessians in each bin of the root, or of one child of each node above: its left (0) or right (1)."""
    offsets, total = np.cumsum(sizes) - sizes, int(sizes.sum())

    def run(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        first, nodes = (1 << level) - 1, max(1, (1 << level) // 2)
        out = np.zeros((len(feature), 2, nodes, total))
        for bins, weights, labels, margins in blocks:
            for m in range(len(feature)):
                at = walk(feature[m], cut[m], bins, level) - first
                used = np.flatnonzero((at >= 0) & (weights[m] > 0))
                place = at[used]
                if level:
                    place, child = place >> 1, place & 1
                    own = child == sides[m][place]
                    used, place = used[own], place[own]
                sums = gradients(weights[m][used], labels[used], margins[m][used])
                for f, size in enumerate(sizes):
                    there = place * size + bins[f][used]
                    for i in (0, 1):
                        found = np.bincount(there, sums[i], minlength=nodes * size).reshape(nodes, size)
                        out[m, i, :, offsets[f]:offsets[f] + size] += found
        yield out

    return run


def lighter(trees: list[Tree], level: int, above: np.ndarray | None, sizes: np.ndarray) -> np.ndarray | None:
    """For each node of the level above the child with less hessian: only that one is summed up from rows."""
    if above is None:
        return None
    first, starts, sides = (1 << (level - 1)) - 1, np.cumsum(sizes) - sizes, np.zeros((len(trees), 1 << (level - 1)), np.int64)
    for m, tree in enumerate(trees):
        for node in range(1 << (level - 1)):
            feature = tree.feature[first + node]
            if feature >= 0:
                own = above[m, 1, node, starts[feature]:starts[feature] + sizes[feature]]
                sides[m, node] = 2 * own[:tree.cut[first + node] + 1].sum() > own.sum()
    return sides


def both_children(built: np.ndarray, above: np.ndarray | None, sides: np.ndarray | None) -> np.ndarray:
    """Histograms of all nodes of a level; the sums are exact, so the other child is the difference."""
    if above is None:
        return built
    out = np.empty((*built.shape[:2], 2 * built.shape[2], built.shape[3]))
    right = sides[:, None, :, None] == 1
    out[:, :, 0::2] = np.where(right, above - built, built)
    out[:, :, 1::2] = np.where(right, built, above - built)
    return out


def advanced(feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, depth: int):
    """Blocks with the margins after one more tree of each model."""
    def run(block: tuple) -> tuple:
        bins, weights, labels, margins = block
        grown = np.stack([leaf[m][walk(feature[m], cut[m], bins, depth)] for m in range(len(leaf))])
        return bins, weights, labels, margins + grown

    return run


def best_split(g: np.ndarray, h: np.ndarray, sizes: list[int], s: Settings) -> tuple[float, int, int]:
    """(gain, feature, bin) of a node's best split from its histograms; the first of equal ones."""
    best, at = (0.0, -1, 0), 0
    for feature, size in enumerate(sizes):
        own_g, own_h = g[at:at + size], h[at:at + size]
        at += size
        left_g, left_h = np.cumsum(own_g)[:-1], np.cumsum(own_h)[:-1]
        right_g, right_h = own_g.sum() - left_g, own_h.sum() - left_h
        allowed = (left_h >= s.min_child_weight) & (right_h >= s.min_child_weight)
        if not allowed.any():
            continue
        gain = left_g ** 2 / (left_h + s.l2) + right_g ** 2 / (right_h + s.l2) - own_g.sum() ** 2 / (own_h.sum() + s.l2)
        gain = np.where(allowed, gain / 2, -np.inf)
        cut = int(np.argmax(gain))
        if gain[cut] > max(best[0], s.min_gain):
            best = (float(gain[cut]), feature, cut)
    return best


def grow(tree: Tree, level: int, hist: np.ndarray, cuts: list[np.ndarray], s: Settings) -> None:
    """Split the nodes of a level, and give every new end of a path its weight."""
    sizes = [max(len(c), 1) for c in cuts]
    first = (1 << level) - 1
    for i in range(1 << level):
        node = first + i
        if level and tree.feature[(node - 1) // 2] < 0:
            continue
        g, h = hist[0, i], hist[1, i]
        whole_g, whole_h = g[:sizes[0]].sum(), h[:sizes[0]].sum()
        tree.leaf[node] = -s.step * whole_g / (whole_h + s.l2)
        gain, feature, cut = best_split(g, h, sizes, s)
        if feature < 0:
            continue
        at = sum(sizes[:feature])
        tree.feature[node], tree.cut[node], tree.threshold[node], tree.gain[node] = feature, cut, cuts[feature][cut], gain
        left_g, left_h = g[at:at + cut + 1].sum(), h[at:at + cut + 1].sum()
        tree.leaf[2 * node + 1] = -s.step * left_g / (left_h + s.l2)
        tree.leaf[2 * node + 2] = -s.step * (whole_g - left_g) / (whole_h - left_h + s.l2)


def next_level(trees: list[Tree], level: int, hist: np.ndarray, cuts: list[np.ndarray], s: Settings) -> None:
    for tree, own in zip(trees, hist, strict=True):
        grow(tree, level, own, cuts, s)


def parts(trees: list[Tree], *names: str) -> list[np.ndarray]:
    return [np.stack([getattr(t, name) for t in trees]) for name in names]


def train_here(s: Settings, cuts: list[np.ndarray], models: int):
    """All rounds of one model over a group with all blocks of a small table; the same sums, hence the same trees."""
    sizes = np.array([max(len(c), 1) for c in cuts])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        model, make, blocks = key[0].as_py(), opened(len(cuts), models), []
        for row in zip(*(rows[c].to_pylist() for c in ("bins", "weights", "labels")), strict=True):
            bins, weights, labels, margins = make(row)
            used = weights[model] > 0
            blocks.append((bins[:, used], weights[model:model + 1, used], labels[used], margins[model:model + 1, used]))
        trees = []
        for _ in range(s.rounds):
            own, above = [Tree.empty(s.depth)], None
            for level in range(s.depth):
                sides = lighter(own, level, above, sizes)
                built = next(histograms(*parts(own, "feature", "cut"), level, sizes, sides)(iter(blocks)))
                above = both_children(built, above, sides)
                next_level(own, level, above, cuts, s)
            blocks = [advanced(*parts(own, "feature", "cut", "leaf"), s.depth)(b) for b in blocks]
            trees += own
        kept = json.dumps([{k: v.tolist() for k, v in vars(tree).items()} for tree in trees])
        return pa.table({"model": pa.array([model], pa.int32()), "trees": pa.array([kept])})

    return run
