"""Multinomial logistic regression with an L1 penalty on sparse counts, for rows that fit one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np

MEMORY = 10          # pairs of steps and gradient differences that shape a direction
SUFFICIENT = 1e-4    # share of the expected decrease that a step must reach
SHORTEST = 1e-10     # shortest step tried
STRIP = 1 << 19      # entries that are widened at a time


@dataclass
class Sparse:
    """Entries of a matrix, each listed once: rows, columns and values, the values divided by ``scale`` of their column.

    Sums go over strips of entries in their order, so the matrix needs no memory beside the three arrays, of any width,
    and sums are those of one pass.
    """

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    rows: int
    columns: int
    scale: np.ndarray | None = None

    def _strips(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for a in range(0, len(self.value), STRIP):
            column, value = self.column[a:a + STRIP], self.value[a:a + STRIP].astype(float)
            yield self.row[a:a + STRIP], column, value if self.scale is None else value / self.scale[column]

    def times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.rows)
        for row, column, value in self._strips():
            out = _added(out, row, value * weights[column])
        return out

    def transposed_times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.columns)
        for row, column, value in self._strips():
            out = _added(out, column, value * weights[row])
        return out

    def deviations(self) -> np.ndarray:
        """Population standard deviation of each column; 1 where it is 0."""
        total, squares = np.zeros(self.columns), np.zeros(self.columns)
        for _, column, value in self._strips():
            total, squares = _added(total, column, value), _added(squares, column, value ** 2)
        deviation = np.sqrt(np.maximum(squares / self.rows - (total / self.rows) ** 2, 0.0))
        return np.where(deviation > 0, deviation, 1.0)


def _added(sums: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``sums`` with ``values`` added at places ``at``, one after the other."""
    return np.bincount(np.concatenate((np.arange(len(sums)), at)), np.concatenate((sums, values)), minlength=len(sums))


def minimise(smooth: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, penalty: np.ndarray,
             iterations: int, tolerance: float) -> np.ndarray:
    """Least ``smooth(x) + sum(penalty * |x|)``, ``smooth`` giving value and gradient.

    Quasi-Newton steps inside one orthant at a time: a coordinate with a penalty stops at 0 before it changes its sign.
    Ends after ``iterations`` steps, or where a step gains less than ``tolerance`` of the value.
    """
    value, gradient = smooth(x)
    total = value + penalty @ np.abs(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        up, down = gradient + penalty, gradient - penalty
        at_zero = np.where(up < 0, up, np.where(down > 0, down, 0.0))
        slope = np.where(x > 0, up, np.where(x < 0, down, at_zero))
        direction = -_curved(slope, pairs)
        direction[direction * slope >= 0] = 0.0
        if not direction.any():
            break
        orthant = np.where(x != 0, np.sign(x), -np.sign(slope))
        length = 1.0 if pairs else 1.0 / np.linalg.norm(slope)
        while True:
            moved = x + length * direction
            moved[(moved * orthant < 0) & (penalty > 0)] = 0.0
            value, moved_gradient = smooth(moved)
            moved_total = value + penalty @ np.abs(moved)
            if moved_total <= total + SUFFICIENT * (slope @ (moved - x)):
                break
            length /= 2
            if length < SHORTEST:
                return x
        step, change = moved - x, moved_gradient - gradient
        if step @ change > 0:
            pairs = [*pairs, (step, change)][-MEMORY:]
        gained, x, gradient, total = total - moved_total, moved, moved_gradient, moved_total
        if gained <= tolerance * max(abs(total), 1e-12):
            break
    return x


def _curved(slope: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """``slope`` times the inverse curvature that the last steps tell."""
    out, shares = slope.copy(), []
    for step, change in reversed(pairs):
        share = (step @ out) / (step @ change)
        shares.append(share)
        out -= share * change
    if pairs:
        step, change = pairs[-1]
        out *= (step @ change) / (change @ change)
    for (step, change), share in zip(pairs, reversed(shares), strict=True):
        out += (share - (change @ out) / (step @ change)) * step
    return out


def fit(counts: Sparse, label: np.ndarray, classes: int, penalty: float, iterations: int,
        tolerance: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Weights (columns x classes) and intercepts of least mean log loss + penalty * sum of |weights|.

    The search runs over weights of columns scaled to deviation 1, with the penalty scaled back, so the result is that of
    the columns as they are. Intercepts have no penalty.
    """
    deviation = counts.deviations()
    scaled = replace(counts, scale=deviation)
    truth = label[:, None] == np.arange(classes)
    shape = (counts.columns + 1, classes)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w = x.reshape(shape)
        z = np.stack([scaled.times(w[:-1, k]) for k in range(classes)], axis=1) + w[-1]
        z -= z.max(axis=1, keepdims=True)
        norm = np.log(np.exp(z).sum(axis=1))
        off = (np.exp(z - norm[:, None]) - truth) / counts.rows
        gradient = np.empty(shape)
        for k in range(classes):
            gradient[:-1, k] = scaled.transposed_times(off[:, k])
        gradient[-1] = off.sum(axis=0)
        return float((norm - z[truth]).mean()), gradient.ravel()

    start, costs = np.zeros(shape), np.zeros(shape)
    start[-1] = np.log(np.maximum(truth.mean(axis=0), 1e-12))
    costs[:-1] = penalty / deviation[:, None]
    found = minimise(loss, start.ravel(), costs.ravel(), iterations, tolerance).reshape(shape)
    return found[:-1] / deviation[:, None], found[-1]
