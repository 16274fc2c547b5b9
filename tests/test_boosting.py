"""Second-order boosting against a plain numpy version over raw values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import boosting
from vitrine.operators.features import assemble


def plain_tree(x, y, w, margin, s):
    """Exact greedy tree of one round by trying every value of every feature: leaf weight of each row."""
    p = 1 / (1 + np.exp(-margin))
    g, h = w * (p - y), w * p * (1 - p)
    out = np.zeros(len(y))

    def grow(rows, level):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-9, None, None)
        for f in range(x.shape[1]) if level < s.depth else ():
            for cut in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= cut]
                gl, hl = g[left].sum(), h[left].sum()
                gr, hr = total_g - gl, total_h - hl
                if min(hl, hr) < s.min_child_weight:
                    continue
                gain = (gl ** 2 / (hl + s.l2) + gr ** 2 / (hr + s.l2) - total_g ** 2 / (total_h + s.l2)) / 2
                if gain > best[0] + 1e-7:
                    best = (gain, f, cut)
        if best[1] is None:
            out[rows] = -s.step * total_g / (total_h + s.l2)
            return
        inside = x[rows, best[1]] <= best[2]
        grow(rows[inside], level + 1)
        grow(rows[~inside], level + 1)

    grow(np.flatnonzero(w > 0), 0)
    return out


def data(rows=300, seed=0):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 40, rows), rng.normal(size=rows).round(2), rng.integers(0, 3, rows)], axis=1).astype(float)
    y = ((x[:, 0] > 18) ^ (x[:, 1] > 0.3) | (rng.random(rows) < 0.1)).astype(float)
    return x, y


def frame(spark, x, y, weights):
    rows = [(i, *map(float, v), float(label), [float(w) for w in ws]) for i, (v, label, ws) in enumerate(zip(x, y, weights, strict=True))]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, label double, weights array<double>").repartition(4)


@pytest.mark.parametrize("small", [0, boosting.SMALL_BYTES])
def test_rounds_equal_a_plain_version_for_every_model_in_lockstep(spark, monkeypatch, small):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    monkeypatch.setattr(boosting, "CUT_EVERY", 2)
    monkeypatch.setattr(boosting, "SMALL_BYTES", small)
    x, y = data()
    fold = np.arange(len(y)) % 3
    weights = np.stack([np.ones(len(y)), *[(fold != f) * np.where(y == 1, 2.5, 1.0) for f in range(2)]], axis=1)
    s = boosting.Settings(rounds=5, depth=3, step=0.3)
    forests = boosting.fit_lockstep(frame(spark, x, y, weights), ["a", "b", "c"], models=3, settings=s, bins=1000)
    for m, forest in enumerate(forests):
        margin = np.zeros(len(y))
        for done, tree in enumerate(forest.trees):
            want = plain_tree(x, y, weights[:, m], margin, s)
            got = tree.leaf[tree.nodes(np.ascontiguousarray(x.T), tree.threshold, s.depth)]
            trained = weights[:, m] > 0
            assert np.allclose(got[trained], want[trained], atol=1e-5), (m, done)
            margin += got
        assert np.allclose(forest.margins(x), margin)
        assert np.isclose(forest.importances().sum(), 1)


def test_result_does_not_depend_on_blocks(spark, monkeypatch):
    x, y = data(500, 3)
    seen = []
    for rows, small in ((37, 0), (8192, 0), (37, 1 << 20), (8192, 1 << 20)):
        monkeypatch.setattr(boosting, "BLOCK_ROWS", rows)
        monkeypatch.setattr(boosting, "SMALL_BYTES", small)
        forest = boosting.fit_lockstep(frame(spark, x, y, np.ones((500, 1))), ["a", "b", "c"], settings=boosting.Settings(rounds=4))[0]
        seen.append(forest.to_json())
    assert all(one == seen[0] for one in seen)


def test_cuts_keep_all_few_values_and_quantiles_of_many(spark):
    df = spark.range(5000).select((F.col("id") % 7).cast("double").alias("few"), (F.col("id") * 0.5).alias("many"))
    few, many = boosting.bin_cuts(df, ["few", "many"], bins=50)
    assert few.tolist() == list(range(7))
    assert len(many) == 50 and many[-1] == 2499.5 and np.ptp(np.diff(np.append(-0.5, many))) <= 0.5


def test_estimator_saves_loads_and_scores_alike(spark, tmp_path):
    x, y = data(400, 5)
    df = assemble(frame(spark, x, y, np.ones((400, 1))), ["a", "b", "c"])
    model = boosting.BoostedTrees(rounds=20, depth=3, step=0.3).fit(df)
    scored = model.transform(df)
    rows = scored.select("k", "label", "prediction", F.col("probability")).collect()
    assert all(abs(sum(r["probability"]) - 1) < 1e-12 and (r["probability"][1] > 0.5) == (r["prediction"] == 1) for r in rows)
    assert np.mean([r["label"] == r["prediction"] for r in rows]) > 0.85
    model.write().overwrite().save(str(tmp_path / "model"))
    again = boosting.BoostedTreesModel.load(str(tmp_path / "model"))
    assert sorted(map(str, again.transform(df).collect())) == sorted(map(str, scored.collect()))


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_one_class_alone_has_no_split(spark, label):
    x, _ = data(50)
    forest = boosting.fit_lockstep(frame(spark, x, np.full(50, label), np.ones((50, 1))), ["a", "b", "c"],
                                   settings=boosting.Settings(rounds=2))[0]
    assert all((t.feature < 0).all() for t in forest.trees)
    assert (np.sign(forest.margins(x)) == (1 if label else -1)).all()


def test_a_table_of_some_hundred_thousand_rows_is_not_one_task(spark, monkeypatch):
    """All rounds over all rows in one task took longer than any job for each level."""
    def refused(*_):
        raise AssertionError("one task for all rows")

    monkeypatch.setattr(boosting.tasks, "train_here", refused)
    rows = spark.range(500_000).select((F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 31).cast("double").alias("b"),
                                       (F.col("id") % 97 > 50).cast("double").alias("label"), F.array(F.lit(1.0)).alias("weights"))
    forest = boosting.fit_lockstep(rows, ["a", "b"], settings=boosting.Settings(rounds=2, depth=1))[0]
    assert [(t.feature[0], t.threshold[0]) for t in forest.trees] == [(0, 50.0)] * 2
