"""The L1-penalised softmax fit against its conditions of optimality."""

import numpy as np
import pytest

from vitrine.llm import softmax


def random_counts(rows, columns, classes, seed):
    rng = np.random.default_rng(seed)
    dense = rng.poisson(0.4, (rows, columns)) * rng.integers(1, 9, columns)
    label = (dense[:, :classes] + rng.gumbel(size=(rows, classes))).argmax(axis=1)
    row, column = np.nonzero(dense)
    return dense, softmax.Sparse(row, column, dense[row, column].astype(float), rows, columns), label


@pytest.mark.parametrize("penalty", [0.001, 0.02, 0.2])
def test_optimum(penalty):
    """A weight's gradient is minus or plus the penalty by its sign, and within it where the weight is 0."""
    dense, counts, label = random_counts(400, 12, 3, 5)
    weights, intercepts = softmax.fit(counts, label, 3, penalty, 2000, 0.0)
    z = dense @ weights + intercepts
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    off = (p - (label[:, None] == np.arange(3))) / len(label)
    gradient = dense.T @ off
    assert np.abs(off.sum(axis=0)).max() < 1e-4
    assert np.abs(gradient + penalty * np.sign(weights))[weights != 0].max(initial=0) < 1e-4
    assert np.abs(gradient)[weights == 0].max(initial=0) < penalty + 1e-4


def test_without_columns_the_shares_of_the_classes():
    none = softmax.Sparse(np.zeros(0, int), np.zeros(0, int), np.zeros(0), 10, 0)
    weights, intercepts = softmax.fit(none, np.array([0] * 7 + [1] * 3), 2, 0.1, 50)
    p = np.exp(intercepts) / np.exp(intercepts).sum()
    assert weights.shape == (0, 2) and np.allclose(p, [0.7, 0.3])


def test_sums_are_those_of_whole_arrays_without_widening_them(monkeypatch):
    """Counts of 4 bytes in strips give the same floats as one pass, and take little memory beside the three arrays."""
    import tracemalloc

    rng = np.random.default_rng(2)
    n, rows, columns = 400_000, 900, 500
    row, column = np.sort(rng.integers(0, rows, n)).astype(np.int32), rng.integers(0, columns, n).astype(np.int32)
    value, w, u = rng.integers(1, 9, n).astype(np.uint32), rng.normal(size=columns), rng.normal(size=rows)
    scale = rng.random(columns) + 0.5
    monkeypatch.setattr(softmax, "STRIP", 1 << 14)
    counts = softmax.Sparse(row, column, value, rows, columns, scale)
    tracemalloc.start()
    got, back = counts.times(w), counts.transposed_times(u)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    scaled = value / scale[column]
    assert (got == np.bincount(row, scaled * w[column], minlength=rows)).all()
    assert (back == np.bincount(column, scaled * u[row], minlength=columns)).all()
    assert peak < 3 * value.nbytes
