"""Density clustering through blocks of neighbouring points, and the neighbour search inside tasks."""

import math

import numpy as np
import pytest

from vitrine.operators import dbscan, near_points

from .test_clusters import blobs, brute_dbscan, run_dbscan


def refuse(*args):
    raise AssertionError("pairs of near cells are listed")


@pytest.fixture
def small_blocks(monkeypatch):
    for module, sizes in ((dbscan, {"FEW_CELLS": 0, "BLOCK_ROWS": 40, "ASKED_ROWS": 100}), (near_points, {"LEAF": 8, "ACROSS": 16, "FIRST": 2})):
        for name, value in sizes.items():
            monkeypatch.setattr(module, name, value)
    monkeypatch.setattr(dbscan, "_near_cells", refuse)


def test_many_cells_are_clustered_without_pairs_of_cells(spark, small_blocks):
    """Pairs of near cells were stored: some hundred millions for a million points of six columns."""
    points = blobs(2, 3)
    labels, core = brute_dbscan(points, 0.5, 5)
    got, got_core = run_dbscan(spark, points, 0.5, 5)
    assert (got_core == core).all() and (got == labels).all() and labels.max() >= 2 and (labels == -1).any()


def test_rows_without_a_value_are_near_to_those_of_their_cell_only(spark, small_blocks, monkeypatch):
    near = [(float(i % 4) * 0.01, float(i) * 0.01) for i in range(30)] + [(9.0, 9.0), (math.inf, 1.0)]
    rows = near + [(None, 0.01)] * 4 + [(None, 5.0), (0.01, None)]
    df = spark.createDataFrame([(f"k{i:02d}", *r) for i, r in enumerate(rows)], "k string, a double, b double")
    got = {r.k: (r.is_core, r.dbscan_label) for r in dbscan.dbscan(df, "k", ["a", "b"], 0.5, 4).collect()}
    want = {f"k{i:02d}": (1, 0) if i < 30 else (1, 1) if 32 <= i < 36 else (0, -1) for i in range(len(rows))}
    assert got == want
    monkeypatch.undo()
    finite = df.where("a is null or a < 1e9")
    assert {r.k: (r.is_core, r.dbscan_label) for r in dbscan.dbscan(finite, "k", ["a", "b"], 0.5, 4).collect()} == {
        k: v for k, v in want.items() if k != "k31"}


def test_pairs_on_the_edge_are_decided_by_the_plain_distance():
    rng = np.random.default_rng(3)
    for shift in (0.0, 1e6):
        a = rng.integers(0, 30, (300, 3)) * 0.1 + shift
        b = rng.integers(0, 30, (200, 3)) * 0.1 + shift
        step = a[:, None] - b[None]
        plain = step[..., 0] ** 2 + step[..., 1] ** 2 + step[..., 2] ** 2
        assert (near_points.within(a, b, 0.25) == (plain <= 0.25)).all()


def test_most_points_are_told_apart_by_few_others(monkeypatch):
    """A leaf stops where all of its points have enough around them."""
    met, real = [0], near_points.within

    def counted(a, b, square):
        met[0] += len(a) * len(b)
        return real(a, b, square)

    monkeypatch.setattr(near_points, "within", counted)
    points = near_points.Leaves(np.random.default_rng(1).uniform(0, 4, (8000, 2)))
    assert near_points.enough(points, np.ones(8000), 1.0, 15).all() and met[0] < 8000 ** 2 / 5
    assert (near_points.linked(points, 1.0, 1 / math.sqrt(2)) == 0).all()
