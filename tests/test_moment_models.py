"""Models from moments against models fitted to the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockpulse.operators import moment_models as mm

FEATURES = ["a", "b", "c", "d"]


def made(n=300, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 10, 0.1, 1000] + [5, -3, 2, 40_000]
    x[:, 2] += 0.02 * x[:, 0]
    y = 3 * x[:, 0] - 0.4 * x[:, 1] + 5 * x[:, 2] + rng.normal(size=n) * 2 + 1e6
    return x, y


def frame(spark, x, y):
    rows = [(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame([*rows, (900, None, 1.0, 1.0, 1.0, 1.0), (901, 1.0, 1.0, 1.0, 1.0, None)], "id long, a double, b double, c double, d double, y double")


def solve(x, y, penalty=0.0, spread=1.0):
    z = (x - x.mean(0)) / spread
    beta = np.linalg.solve(z.T @ z + penalty * len(x) * np.eye(x.shape[1]), z.T @ (y - y.mean())) / spread
    return lambda new: y.mean() + (new - x.mean(0)) @ beta


def r2(y, guess):
    return 1 - ((y - guess) ** 2).sum() / ((y - y.mean()) ** 2).sum()


def test_cross_validation_matches_refits(spark):
    x, y = made()
    fold = np.arange(len(x)) % 5
    board = {r.model: r for r in mm.cross_validated(frame(spark, x, y), F.col("id") % 5, FEATURES, "y", {"plain": 0.0, "ridge": 0.3}).collect()}
    for name, penalty in (("plain", 0.0), ("ridge", 0.3)):
        marks, errors = [], []
        for k in range(5):
            guess = solve(x[fold != k], y[fold != k], penalty, x.std(0))(x[fold == k])
            marks.append(r2(y[fold == k], guess))
            errors.append(np.sqrt(((y[fold == k] - guess) ** 2).mean()))
        assert (board[name].r2, board[name].rmse, board[name].r2_spread) == pytest.approx((np.mean(marks), np.mean(errors), np.std(marks)), rel=1e-6)
    assert board["plain"].folds == 5 and {board["plain"]["rank"], board["ridge"]["rank"]} == {1, 2}


def test_elimination_matches_refits(spark):
    x, y = made()
    held = np.arange(len(x)) % 4 == 0
    path = mm.elimination_path(frame(spark, x, y), F.col("id") % 4 == 0, FEATURES, "y").orderBy(F.desc("n_features")).collect()
    left = list(range(4))
    for row in path:
        assert row.n_features == len(left)
        guess = solve(x[~held][:, left], y[~held], 0.0, x[~held][:, left].std(0))
        assert row.train_r2 == pytest.approx(r2(y[~held], guess(x[~held][:, left])), rel=1e-6, abs=1e-9)
        assert row.test_r2 == pytest.approx(r2(y[held], guess(x[held][:, left])), rel=1e-6, abs=1e-9)
        if len(left) > 1:
            fits = {k: r2(y[~held], solve(x[~held][:, rest], y[~held], 0.0, x[~held][:, rest].std(0))(x[~held][:, rest])) for k in left if (rest := [j for j in left if j != k])}
            gone = max(fits, key=lambda k: fits[k])
            assert path[4 - len(left) + 1].removed == FEATURES[gone]
            left.remove(gone)
    assert len(path) == 4 and path[0].removed is None


def test_dependent_and_constant_features_go_first(spark):
    x, y = made()
    x[:, 1], x[:, 3] = 2 * x[:, 0] + 1, 7.0
    path = mm.elimination_path(frame(spark, x, y), F.col("id") % 4 == 0, FEATURES, "y").orderBy(F.desc("n_features")).collect()
    assert [r.removed for r in path[:3]] == [None, "b", "d"] and path[0].train_r2 == pytest.approx(path[2].train_r2)
    board = mm.cross_validated(frame(spark, x, y), F.col("id") % 5, FEATURES, "y", {"plain": 0.0, "ridge": 0.1}).collect()
    assert {r.model: r.folds for r in board}["plain"] == 0 and all(r.rmse is None for r in board if r.folds == 0)


def test_learning_curve_matches_refits_and_leaves_thin_shares_null(spark):
    x, y = made(120)
    ids = np.arange(len(x))
    held = ids % 4 == 0
    curve = mm.learning_curve(frame(spark, x, y), F.col("id") % 4 == 0, F.col("id") % 100, [3, 50, 100], FEATURES, "y").orderBy("share").collect()
    for row in curve:
        part = ~held & (ids % 100 < row.share)
        assert row.rows == part.sum()
        if row.share == 3:
            assert row.r2 is None and row.mae is None
        else:
            guess = solve(x[part], y[part], 0.0, x[part].std(0))(x[held])
            assert (row.r2, row.mae) == pytest.approx((r2(y[held], guess), np.abs(y[held] - guess).mean()), rel=1e-6)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "id long, a double, b double, c double, d double, y double")
    assert mm.elimination_path(empty, F.col("id") % 4 == 0, FEATURES, "y").collect() == []
    assert mm.cross_validated(empty, F.col("id") % 5, FEATURES, "y", {"plain": 0.0}).collect() == []
    assert [r.r2 for r in mm.learning_curve(empty, F.col("id") % 4 == 0, F.col("id") % 100, [50, 100], FEATURES, "y").collect()] == [None, None]
