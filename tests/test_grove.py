"""Forests grown in tasks, against brute force and against Spark's learner; the grids of the queries."""

from __future__ import annotations

import inspect

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sondage.catalog import learning
from sondage.functions.fixed import CV_DEPTHS, CV_MIN_LEAF, CV_TREES, FOREST_DEPTHS, FOREST_SIZES
from sondage.operators import grove, metrics, models
from sondage.plans import reports


@pytest.fixture(scope="module")
def noisy(spark):
    """Three classes by two of five features; a fifth of the labels is drawn."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 5))
    x[:, 4] = np.round(x[:, 4])
    y = np.where(rng.random(900) < 0.2, rng.integers(0, 3, 900), (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.3))
    rows = [(i, float(c), Vectors.dense(v), i % 3) for i, (v, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "label_idx", "features", "fold"]).persist()


def halves(df):
    return df.filter("id % 2 = 0"), df.filter("id % 2 = 1")


@pytest.mark.parametrize("at_once,min_leaf", [(2_000_000, 1), (400, 1), (400, 6)])
def test_best_splits(monkeypatch, at_once, min_leaf):
    """All features of a node together and a few at a time."""
    monkeypatch.setattr(grove, "CELLS_AT_ONCE", at_once)
    rng = np.random.default_rng(1)
    n, n_classes = 150, 4
    bins, y, w = rng.integers(0, 9, (n, 7)).astype(np.uint8), rng.integers(0, n_classes, n), rng.integers(1, 4, n)
    slot = np.r_[np.zeros(90, int), rng.integers(1, 12, n - 90)]
    slot = np.unique(slot, return_inverse=True)[1]
    total = np.stack([np.bincount(y[slot == s], w[slot == s], n_classes) for s in range(slot.max() + 1)]).astype(np.int64)
    tried = np.stack([rng.permutation(7)[:4] for _ in total])
    score, feature, cut = grove._best_splits(bins, y, w, slot, total, tried, min_leaf)

    def value(s, f, c):
        here, goes_left = slot == s, bins[:, f] <= c
        parts = [np.bincount(y[here & side], w[here & side], n_classes) for side in (goes_left, ~goes_left)]
        return sum((p * p).sum() / p.sum() for p in parts) if min(p.sum() for p in parts) >= min_leaf else -np.inf
    for s in range(len(total)):
        best = max(value(s, f, c) for f in tried[s] for c in range(9))
        assert score[s] == pytest.approx(best)
        if best > -np.inf:
            assert feature[s] in tried[s] and value(s, feature[s], cut[s]) == pytest.approx(best)


def test_trees():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 32, (400, 6)).astype(np.uint8)
    y = (bins[:, 0] > 12).astype(int) + (rng.random(400) < 0.2)
    deep = grove.grow_tree(bins, y, 3, 3, 30, 4, np.random.default_rng([5, 1]))
    inner = np.flatnonzero(deep.left >= 0)
    assert (deep.value[inner] == deep.value[deep.left[inner]] + deep.value[deep.right[inner]]).all()
    assert deep.value.sum(axis=1).min() >= 4 and deep.value[0].sum() == np.random.default_rng([5, 1]).poisson(1.0, 400).sum()
    depths = [0, 1, 3, 6, 30]
    got = deep.votes(bins, depths)
    for i, depth in enumerate(depths):  # a tree of less depth is the upper part of the deep one
        alone = grove.grow_tree(bins, y, 3, 3, depth, 4, np.random.default_rng([5, 1]))
        assert len(alone.levels) <= depth + 1 and np.array_equal(got[:, i], alone.votes(bins, [depth])[:, 0])
        leaf = alone.leaves(depth)
        both = [n for n in np.flatnonzero(~leaf) if leaf[alone.left[n]] and leaf[alone.right[n]]]
        assert all(alone.value[alone.left[n]].argmax() != alone.value[alone.right[n]].argmax() for n in both)
    assert np.allclose(got.sum(axis=2), 1)
    pure = grove.grow_tree(bins, np.zeros(400, int), 2, 3, 30, 1, np.random.default_rng(1))
    assert pure.left.tolist() == [-1]


def test_tried_features():
    tried = grove._tried(np.random.default_rng(2), 6000, 7, 3)
    assert all(len(set(t)) == 3 for t in tried.tolist())
    assert np.allclose(np.bincount(tried.ravel(), minlength=7) / 6000, 3 / 7, atol=0.03)


def test_thresholds():
    few = np.array([1.0, 1, 2, 5])
    assert grove._thresholds_of(few, 32).tolist() == [1.5, 3.5] and grove._thresholds_of(few[:2], 32).size == 0
    many = grove._thresholds_of(np.arange(1000.0), 32)
    assert len(many) == 31 and np.ptp(np.diff(many)) <= 1


def test_grown_sweep_is_like_sparks(spark, noisy, monkeypatch):
    """The forests of both learners have about the same accuracy, in training as well."""
    train, val = halves(noisy)
    want = models.forest_sweep(train, val, (20, 60), (3, 12)).orderBy("position").collect()
    monkeypatch.setattr(models, "GROWN_AT_ONCE", 0)
    got = models.forest_sweep(train, val, (20, 60), (3, 12)).orderBy("position").collect()
    again = models.forest_sweep(train.repartition(5), val.repartition(3), (60, 20), (12,)).collect()
    assert [(r["trees"], r["depth"]) for r in got] == [(r["trees"], r["depth"]) for r in want] == [(20, 3), (20, 12), (60, 3), (60, 12)]
    for a, b in zip(got, want):
        assert a["train_accuracy"] == pytest.approx(b["train_accuracy"], abs=0.04)
        assert a["val_accuracy"] == pytest.approx(b["val_accuracy"], abs=0.05) and a["val_accuracy"] > 0.7
    held = {(r["trees"], r["depth"]): r[-2:] for r in got}
    assert all(held[r["trees"], r["depth"]] == r[-2:] for r in again)  # whatever the partitions and the rest of the grid


def test_grown_cross_validation(spark, noisy, monkeypatch):
    grid = dict(n_folds=3, trees=(10, 30), depths=(8, 2), min_leaf=(1, 5))
    _, want = models.forest_cross_validation(noisy, **grid)
    monkeypatch.setattr(models, "GROWN_AT_ONCE", 0)
    model, table = models.forest_cross_validation(noisy, **grid)
    rows = table.orderBy("position").collect()
    assert [r[:4] for r in rows] == [r[:4] for r in want.orderBy("position").collect()] and len(rows) == 8
    assert all(a["accuracy"] == pytest.approx(b["accuracy"], abs=0.05) for a, b in zip(rows, want.orderBy("position").collect()))
    best = max(rows, key=lambda r: (r["accuracy"], -r["position"]))
    assert isinstance(model, grove.GrownForest) and model.getNumTrees == best["trees"]
    predicted = model.transform(noisy)
    assert predicted.count() == 900 and sorted(r[0] for r in predicted.select("label_idx").collect()) == sorted(r[0] for r in noisy.select("label_idx").collect())
    assert metrics.accuracy_of(predicted, "label_idx", "prediction") > 0.75


def test_a_large_forest_is_grown_in_tasks(spark, noisy, monkeypatch):
    """It took a fit of Spark's learner for every few trees; the accuracy is that of one fit."""
    train, val = halves(noisy)
    whole = models.forest_accuracy(train, val, 40, 30)
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda *a: pytest.fail("fitted by Spark's learner"))
    assert models.forest_accuracy(train, val, 40, 30, at_once=1000) == pytest.approx(whole, abs=0.04)


class Seen(Exception):
    pass


@pytest.mark.parametrize("name,place,function,grid", [
    ("rf_grid", models, "forest_sweep", {"sizes": FOREST_SIZES, "depths": FOREST_DEPTHS}),
    ("rf_cv", models, "forest_cross_validation", {"trees": CV_TREES, "depths": CV_DEPTHS, "min_leaf": CV_MIN_LEAF, "n_folds": 5}),
    ("rf_tuned", reports.models, "forest_cross_validation", {"trees": CV_TREES, "depths": CV_DEPTHS, "min_leaf": CV_MIN_LEAF, "n_folds": 5})])
def test_queries_run_whole_grids(spark, monkeypatch, tmp_path, name, place, function, grid):
    """The queries left out most of their settings."""
    spark.range(60).select(F.col("id").alias("vec_id"), (F.col("id") % 10).cast("int").alias("label"),
                           F.array(F.rand(1), F.rand(2)).cast("array<float>").alias("embedding")).write.parquet(str(tmp_path / "embeddings.parquet"))
    real = getattr(place, function)

    def seen(*args, **kwargs):
        bound = inspect.signature(real).bind(*args, **kwargs)
        bound.apply_defaults()
        raise Seen({k: bound.arguments[k] for k in grid})
    monkeypatch.setattr(place, function, seen)
    with pytest.raises(Seen) as found:
        getattr(learning, name)(spark, str(tmp_path))
    assert found.value.args[0] == grid


def test_many_rows_are_not_broadcast(spark, monkeypatch):
    """The driver ran out of memory on the keys of a large table in a small file."""
    from compare import SF_DIR
    from sondage.catalog import layouts

    def rows(df):
        return sorted(map(str, df.collect()))
    want = rows(layouts.responses(spark, SF_DIR))
    monkeypatch.setattr(layouts, "BROADCAST_ROWS", 10)
    got = layouts.responses(spark, SF_DIR)
    assert "Broadcast" not in got.select("doc_id", "label")._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == want
