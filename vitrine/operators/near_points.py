"""Neighbours within eps among blocks of points: plain functions over arrays, run inside tasks."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

LEAF = 128       # points of a leaf
ACROSS = 2048    # points that a leaf meets at a time
FIRST = 8        # nearest leaves that are met first


def halve(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points and the starts of its leaves: the widest side is halved until a leaf has at most ``most`` points."""
    order, starts, todo = np.arange(len(x)), [], [(0, len(x))]
    while todo:
        low, high = todo.pop()
        if high - low <= most:
            starts.append(low)
            continue
        own = order[low:high]
        here = x[own]
        side, middle = int(np.argmax(np.ptp(here, axis=0))), (high - low) // 2
        order[low:high] = own[np.argpartition(here[:, side], middle)]
        todo += [(low + middle, high), (low, low + middle)]
    return order, np.array(starts + [len(x)], dtype=np.int64)


class Leaves:
    """Points in the order of their leaves, with the box of each leaf."""

    def __init__(self, x: np.ndarray):
        self.order, self.starts = halve(x, LEAF)
        self.x = x[self.order]
        self.count = len(self.starts) - 1 if len(x) else 0
        at = self.starts[:self.count]
        self.lo = np.minimum.reduceat(self.x, at) if self.count else self.x
        self.hi = np.maximum.reduceat(self.x, at) if self.count else self.x

    def rows(self, leaf: int) -> slice:
        return slice(self.starts[leaf], self.starts[leaf + 1])

    def members(self, leaves: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(self.starts[k], self.starts[k + 1]) for k in leaves])

    def gaps(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Squared smallest distance of a box to each leaf's."""
        step = np.maximum(np.maximum(self.lo - hi, lo - self.hi), 0.0)
        return np.einsum("ij,ij->i", step, step)

    def same(self, values: np.ndarray) -> np.ndarray:
        """The value of each leaf whose points all have the same one, else -2."""
        at = self.starts[:self.count]
        least, most = np.minimum.reduceat(values, at), np.maximum.reduceat(values, at)
        return np.where(least == most, least, -2)


def within(a: np.ndarray, b: np.ndarray, square: float) -> np.ndarray:
    """Which pairs are within eps: products decide what is clear, the plain squared distance decides what is near the edge."""
    centre = a.mean(axis=0)
    p, q = a - centre, b - centre
    pp, qq = np.einsum("ij,ij->i", p, p), np.einsum("ij,ij->i", q, q)
    found = np.column_stack([p, pp, np.ones(len(p))]) @ np.column_stack([-2.0 * q, np.ones(len(q)), qq]).T
    spread, largest = pp.max() + qq.max(), max(np.abs(a).max(), np.abs(b).max())
    slack = 1e-12 * (spread + square) + 1e-13 * largest * np.sqrt(spread)
    sure = found <= square - slack
    maybe = found <= square + slack
    if np.count_nonzero(sure) != np.count_nonzero(maybe):
        i, j = np.nonzero(maybe & ~sure)
        total = np.zeros(len(i))
        for d in range(a.shape[1]):
            step = a[i, d] - b[j, d]
            total += step * step
        sure[i, j] = total <= square
    return sure


def enough(points: Leaves, w: np.ndarray, square: float, least: int) -> np.ndarray:
    """Which points have a weight of at least ``least`` within eps among ``points``; a leaf stops when all of its points have."""
    core = np.zeros(len(points.x), bool)
    for leaf in range(points.count):
        gap = points.gaps(points.lo[leaf], points.hi[leaf])
        near = np.flatnonzero(gap <= square * (1.0 + 1e-9))
        centre = (points.lo[leaf] + points.hi[leaf]) / 2
        middle = (points.lo[near] + points.hi[near]) / 2 - centre
        near = near[np.argsort(np.einsum("ij,ij->i", middle, middle), kind="stable")]
        open_rows = np.arange(points.starts[leaf], points.starts[leaf + 1])
        sums, at, step = np.zeros(len(open_rows)), 0, FIRST
        while at < len(near) and len(open_rows):
            others = points.members(near[at:at + step])
            sums = sums + within(points.x[open_rows], points.x[others], square) @ w[others]
            core[open_rows[sums >= least]] = True
            open_rows, sums = open_rows[sums < least], sums[sums < least]
            at, step = at + step, ACROSS // LEAF
    return core


def _root(parent: np.ndarray, values: np.ndarray) -> np.ndarray:
    while True:
        above = parent[values]
        if (above == values).all():
            return values
        values = parent[above]


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the trees of a[i] and b[i]; the smallest point is the root."""
    while len(a):
        a, b = _root(parent, a), _root(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def linked(points: Leaves, square: float, side: float) -> np.ndarray:
    """For each point the first point of a set of linked ones: those of a cell, of a leaf and of its nearest leaves.

    Points that are linked in no other way may stay apart; no point is linked to one it does not reach.
    """
    n = len(points.x)
    parent = np.arange(n)
    if not n:
        return parent
    _, cells = np.unique(np.floor(points.x / side).astype(np.int64), axis=0, return_inverse=True)
    order = np.argsort(cells, kind="stable")
    first = np.searchsorted(cells[order], cells[order])
    _merge(parent, order, order[first])
    for leaf in range(points.count):
        own = np.arange(points.starts[leaf], points.starts[leaf + 1])
        gap = points.gaps(points.lo[leaf], points.hi[leaf])
        near = np.flatnonzero(gap <= square * (1.0 + 1e-9))
        near = near[np.argsort(gap[near], kind="stable")][:2 * FIRST]
        others = points.members(near)
        a, b = _root(parent, own), _root(parent, others)
        # Only one side of a pair has to be outside of the set that most points belong to.
        values, counts = np.unique(np.concatenate([a, b]), return_counts=True)
        if len(values) == 1:
            continue
        main = values[counts.argmax()]
        for i, j in ((np.flatnonzero(a != main), np.arange(len(b))), (np.flatnonzero(a == main), np.flatnonzero(b != main))):
            if len(i) and len(j):
                p, q = np.nonzero(within(points.x[own[i]], points.x[others[j]], square))
                pairs = np.unique(a[i][p] * n + b[j][q])
                _merge(parent, pairs // n, pairs % n)
    return _root(parent, np.arange(n))


def meet(asked: Leaves, asked_comp: np.ndarray, x: np.ndarray, comp: np.ndarray, square: float):
    """Pairs within eps of ``asked`` points and points ``x`` that still say something: (place in asked, row of x), leaf by leaf.

    A component is that of a core point, -1 where it is not known whether a point is core. Points of one component,
    and a core point with an unknown ``x``, have nothing to say to each other.
    """
    here = Leaves(x)
    if not here.count or not asked.count:
        return
    comp = comp[here.order]
    ours, theirs = asked.same(asked_comp), here.same(comp)
    for leaf in range(here.count):
        near = asked.gaps(here.lo[leaf], here.hi[leaf]) <= square * (1.0 + 1e-9)
        if theirs[leaf] >= 0:
            near &= ours != theirs[leaf]
        if theirs[leaf] == -1:
            near &= (ours == -1) | (ours == -2)
        near = np.flatnonzero(near)
        own = here.rows(leaf)
        for at in range(0, len(near), ACROSS // LEAF):
            others = asked.members(near[at:at + ACROSS // LEAF])
            a, b = asked_comp[others], comp[own]
            told = others[(a == -1) | (b.max() >= 0)]
            if not len(told):
                continue
            j, i = np.nonzero(within(here.x[own], asked.x[told], square))
            a, b = asked_comp[told[i]], b[j]
            says = (a == -1) | ((b >= 0) & (a != b))
            yield told[i[says]], here.order[own][j[says]]


def borders(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sides and cuts of a tree of ``depth`` halvings, as a heap: a point goes right where its side reaches the cut."""
    sides, cuts, held = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf), {0: sample}
    for node in range(2 ** depth - 1):
        own = held.pop(node)
        if len(own) > 1 and np.ptp(own, axis=0).max() > 0:
            side = int(np.argmax(np.ptp(own, axis=0)))
            values = np.sort(own[:, side])
            cut = values[len(values) // 2]
            sides[node], cuts[node] = side, cut if cut > values[0] else values[np.searchsorted(values, cut, "right")]
        right = own[:, sides[node]] >= cuts[node]
        held[2 * node + 1], held[2 * node + 2] = own[~right], own[right]
    return sides, cuts


def matrix(batch, dims: int) -> np.ndarray:
    return np.column_stack([batch.column(f"x{i}").to_numpy() for i in range(dims)])


def placed(batches, dims: int, sides: np.ndarray, cuts: np.ndarray):
    """Arrow batches with the ``block`` of each point."""
    for batch in batches:
        x, node = matrix(batch, dims), np.zeros(batch.num_rows, np.int64)
        while len(node) and node[0] < len(sides):
            node = 2 * node + 1 + (x[np.arange(len(x)), sides[node]] >= cuts[node])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node - len(sides))], [*batch.schema.names, "block"])


def block_groups(rows: pd.DataFrame, dims: int, square: float, side: float, least: int) -> pd.DataFrame:
    """Points of a block with ``comp``: for those that are core by the block alone a point they are linked to, else -1."""
    points = Leaves(rows[[f"x{i}" for i in range(dims)]].to_numpy(float))
    rows = rows.iloc[points.order]
    core = np.flatnonzero(enough(points, rows["w"].to_numpy(float), square, least))
    inner, comp, ids = Leaves(points.x[core]), np.full(len(rows), -1), rows["id"].to_numpy()
    comp[core[inner.order]] = ids[core[inner.order]][linked(inner, square, side)]
    return rows.assign(comp=comp)


def told(batches, asked: Leaves, ids: np.ndarray, comp: np.ndarray, dims: int, square: float):
    """What the points of the batches tell those asked: rows (kind, a, b, n).

    ``weight``: point a, whose status is unknown, has weight n within eps; ``comp``: it reaches core points of b;
    ``point``: it reaches point b of unknown status; ``link``: core points of a and b reach each other.
    """
    def out(kind: str, a, b, n=None):
        if n is None:
            a, b = np.unique(np.stack([a, b]), axis=1)
            n = np.zeros(len(a), np.int64)
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.string()), *(pa.array(v, pa.int64()) for v in (a, b, n))],
                                          ["kind", "a", "b", "n"])

    for batch in batches:
        own, theirs, w = batch.column("id").to_numpy(), batch.column("comp").to_numpy(), batch.column("w").to_numpy()
        weight = np.zeros(len(ids), np.int64)
        for i, j in meet(asked, comp, matrix(batch, dims), theirs, square):
            open_, known = comp[i] == -1, theirs[j] >= 0
            np.add.at(weight, i[open_], w[j[open_]])
            for kind, rows, a, b in (("comp", open_ & known, ids, theirs), ("point", open_ & ~known, ids, own), ("link", ~open_, comp, theirs)):
                if rows.any():
                    yield out(kind, a[i[rows]], b[j[rows]])
        seen = np.flatnonzero(weight)
        if len(seen):
            yield out("weight", ids[seen], ids[seen], weight[seen])
