"""Tail probabilities, tiny solves and series tests against direct least squares."""

import math
from datetime import date

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blockpulse.functions import numeric
from blockpulse.operators import causality as cau
from blockpulse.operators import models
from blockpulse.operators import series as ser


def _beta_by_angle(a: float, b: float, x: float, n: int = 20001) -> float:
    top = math.asin(math.sqrt(x))
    t = np.linspace(0.0, top, n)
    y = 2 * np.sin(t) ** (2 * a - 1) * np.cos(t) ** (2 * b - 1)
    h = top / (n - 1)
    area = h / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())
    return area * math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(2, 150), st.floats(0.001, 30))
def test_f_tail(d1, d2, f):
    expected = _beta_by_angle(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))
    assert numeric.f_upper_tail(f, d1, d2) == pytest.approx(expected, abs=1e-8)


def test_f_tail_published_values():
    assert numeric.f_upper_tail(4.9646, 1, 10) == pytest.approx(0.05, abs=1e-4)
    assert numeric.f_upper_tail(3.8853, 2, 12) == pytest.approx(0.05, abs=1e-4)


def test_unit_root_surface_at_critical_values():
    assert numeric.adf_pvalue(-3.43) == pytest.approx(0.01, abs=5e-4)
    assert numeric.adf_pvalue(-2.86) == pytest.approx(0.05, abs=5e-4)
    assert numeric.adf_pvalue(-2.57) == pytest.approx(0.10, abs=1e-3)
    assert numeric.adf_pvalue(3.0) == 1.0
    assert numeric.adf_pvalue(-19.0) == 0.0


def _ssr(x, y):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    r = y - x @ beta
    return float(r @ r), beta


def _granger_direct(x, y, lags):
    n = len(y)
    target = y[lags:]
    ylags = np.column_stack([y[lags - k : n - k] for k in range(1, lags + 1)])
    xlags = np.column_stack([x[lags - k : n - k] for k in range(1, lags + 1)])
    one = np.ones((n - lags, 1))
    restricted, _ = _ssr(np.hstack([one, ylags]), target)
    full, _ = _ssr(np.hstack([one, ylags, xlags]), target)
    dof = n - lags - 2 * lags - 1
    return (restricted - full) / lags / (full / dof)


def _series_frame(spark, columns: dict[str, np.ndarray]):
    n = len(next(iter(columns.values())))
    days = pd.date_range("2000-01-01", periods=n, freq="D").date
    wide = spark.createDataFrame(pd.DataFrame({"ts": days, **columns}))
    return ser.to_long(wide, "ts", list(columns))


def test_granger_equals_direct_regression(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=90).cumsum()
    y = np.concatenate([[0.0], 0.6 * x[:-1]]) + rng.normal(size=90)
    z = rng.normal(size=90)
    pairs = cau.paired(_series_frame(spark, {"x": x, "z": z, "flat": np.full(90, 2.0), "y": y}), "y")
    got = {(r["feature"], r["lag"]): r for r in cau.granger(pairs, 4).collect()}
    for name, cause in (("x", x), ("z", z)):
        for lag in range(1, 5):
            row = got[(name, lag)]
            assert row["n"] == 90 - lag
            assert row["f_stat"] == pytest.approx(_granger_direct(cause, y, lag), rel=1e-8)
    assert got[("x", 1)]["p_value"] < 1e-6
    assert all(got[("flat", k)]["p_value"] is None for k in range(1, 5))


def test_granger_start_search_equals_separate_tests(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=40), rng.normal(size=40)
    pairs = cau.paired(_series_frame(spark, {"x": x, "y": y}), "y")
    days = pd.date_range("2000-01-01", periods=40, freq="D").date
    got = {(r["start"], r["lag"]): r for r in cau.granger_starts(pairs, 2).collect()}
    for start in (0, 5, 20):
        for lag in (1, 2):
            expected = _granger_direct(x[start:], y[start:], lag)
            assert got[(days[start], lag)]["f_stat"] == pytest.approx(expected, rel=1e-7)


def test_block_means_before_granger(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=60), rng.normal(size=60)
    pairs = cau.paired(_series_frame(spark, {"x": x, "y": y}), "y")
    got = {r["lag"]: r for r in cau.granger(pairs, 2, block=3).collect()}
    bx, by = x.reshape(20, 3).mean(axis=1), y.reshape(20, 3).mean(axis=1)
    assert got[2]["f_stat"] == pytest.approx(_granger_direct(bx, by, 2), rel=1e-8)


def _adf_direct(v):
    d = np.diff(v)
    n = len(v)
    most = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)

    def design(k, drop):
        rows = range(drop, len(d))
        x = np.array([[1.0, v[i], *[d[i - j] for j in range(1, k + 1)]] for i in rows])
        return x, d[drop:]

    scores = []
    for k in range(most + 1):
        x, t = design(k, most)
        ssr, _ = _ssr(x, t)
        scores.append((len(t) * np.log(ssr / len(t)) + 2 * (k + 2), k))
    k = min(scores)[1]
    x, t = design(k, k)
    ssr, beta = _ssr(x, t)
    s2 = ssr / (len(t) - x.shape[1])
    return k, beta[1] / np.sqrt(s2 * np.linalg.inv(x.T @ x)[1, 1])


def test_adf_equals_direct_regression(spark):
    rng = np.random.default_rng(11)
    walk, noise = rng.normal(size=120).cumsum(), rng.normal(size=120)
    ar = np.zeros(120)
    for i in range(3, 120):
        ar[i] = 0.5 * ar[i - 1] - 0.3 * ar[i - 3] + rng.normal()
    columns = {"walk": walk, "noise": noise, "ar": ar}
    got = {r["series_id"]: r for r in cau.adf_test(_series_frame(spark, columns)).collect()}
    for name, v in columns.items():
        k, t = _adf_direct(v)
        assert got[name]["used_lag"] == k
        assert got[name]["statistic"] == pytest.approx(t, rel=1e-6)
        assert got[name]["p_value"] == pytest.approx(numeric.adf_pvalue(t), abs=1e-6)


def test_make_stationary_differences_only_what_needs_it(spark):
    rng = np.random.default_rng(2)
    noise, walk = rng.normal(size=150), rng.normal(size=150).cumsum()
    frame = _series_frame(spark, {"noise": noise, "walk": walk, "twice": walk.cumsum()})
    orders = {r["series_id"]: r["order"] for r in cau.make_stationary(frame).select("series_id", "order").distinct().collect()}
    assert orders["noise"] == 0
    assert orders["walk"] >= 1
    assert orders["twice"] >= orders["walk"]


def test_partial_autocorrelations_solve_yule_walker():
    rng = np.random.default_rng(1)
    v = rng.normal(size=200)
    for i in range(1, 200):
        v[i] += 0.6 * v[i - 1]
    c = v - v.mean()
    acf = [float(c[k:] @ c[: len(c) - k] / (c @ c)) for k in range(8)]
    got = numeric.partial_autocorrelations(acf)
    for k in range(1, 8):
        r = np.array([[acf[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(r, np.array(acf[1 : k + 1]))[-1], abs=1e-10)


def test_optimize_shifts_finds_the_planted_shift(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=120), rng.normal(size=120)
    y = np.zeros(120)
    y[4:] = 3 * a[1:117]  # a three rows earlier
    y[1:] += 2 * b[:-1]
    y[3] = 0
    days = pd.date_range("2000-01-01", periods=120, freq="D").date
    wide = spark.createDataFrame(pd.DataFrame({"ts": days, "y": y, "a": a, "b": b}))
    best = cau.optimize_shifts(wide, "ts", "y", ["a", "b"], {"b": 1}, max_shift=5).orderBy("mae").first()
    assert (best["a"], best["b"]) == (3, 1)
    assert best["mae"] < 1e-6


def _series(spark, values):
    rows = [(name, date(2015 + i // 12, 1 + i % 12, 1), float(v)) for name, own in values.items() for i, v in enumerate(own)]
    return spark.createDataFrame(rows, "series_id string, ts date, value double")


def test_untestable_series_stay(spark):
    noise = np.random.default_rng(3).normal(size=60)
    long = _series(spark, {"noise": noise, "walk": np.cumsum(np.cumsum(np.cumsum(np.cumsum(np.cumsum(noise))))), "constant": [5] * 60, "line": range(60), "short": [1, 4, 9]})
    tests = {r["series_id"]: r for r in cau.adf_test(long).collect()}
    assert set(tests) == {"noise", "walk", "constant", "line", "short"}
    assert {n for n, r in tests.items() if r["status"] == "untestable"} == {"constant", "line", "short"}
    assert all((r["p_value"] is None) == (r["status"] == "untestable") for r in tests.values())
    steady = {(r["series_id"], r["order"], r["stationary"]) for r in cau.make_stationary(long).collect()}
    assert {n for n, _, _ in steady} == set(tests) and ("noise", 0, True) in steady and ("constant", 0, None) in steady
    stopped = {(r["series_id"], r["order"], r["stationary"]) for r in cau.make_stationary(long, max_order=0).collect()}
    assert ("walk", 0, False) in stopped


def test_untestable_series_have_no_figures(spark):
    """Two changes fit exactly; what rounding leaves of the residuals makes no fit of them."""
    rng = np.random.default_rng(11)
    rows = [(f"s{i}", date(2020, 1, 1 + t), float(v)) for i in range(40) for t, v in enumerate(rng.normal(size=3))]
    tests = cau.adf_test(spark.createDataFrame(rows, "series_id string, ts date, value double")).collect()
    assert {tuple(r)[1:] for r in tests} == {(None, None, None, None, "untestable")} and len(tests) == 40


def test_lag_limit_is_an_argument(spark):
    long = _series(spark, {"noise": np.random.default_rng(4).normal(size=300)})
    assert cau.adf_test(long, most_lags=1).first()["used_lag"] <= 1


def test_long_series_follow_the_lag_rule(spark, monkeypatch):
    long = spark.range(85_000).selectExpr("'a' AS series_id", "id AS ts", "rand(1) AS value").unionAll(spark.range(50).selectExpr("'b'", "id", "rand(2)"))
    assert cau._longest_rule(long, ["series_id"]) >= 65
    seen, rows = [], cau._adf_rows
    monkeypatch.setattr(cau, "_adf_rows", lambda *a: seen.append(rows(*a)) or seen[0])
    for test in (cau.adf_test, lambda x: cau.make_stationary(x, max_order=0)):
        seen.clear()
        test(long)
        limits = seen[0].groupBy("series_id").agg(F.max("max_lag").alias("lag"), F.max(F.size("past")).alias("held")).collect()
        assert {r.series_id: r.lag for r in limits} == {"a": 65, "b": 11} and all(r.held >= r.lag for r in limits)


def test_starts_are_summed_by_spark(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(30, 2))
    rows = [(f, date(2015 + i // 12, 1 + i % 12, 1), float(x[i, k]), float(x[max(0, i - 1), k] + x[i, 1 - k])) for k, f in enumerate("ab") for i in range(30)]
    pairs = spark.createDataFrame(rows, "feature string, ts date, x double, y double")
    starts = cau.granger_starts(pairs, 3)
    assert "InPandas" not in starts._jdf.queryExecution().toString()
    got = {(r.feature, r.start, r.lag): (r.n, r.p_value) for r in starts.collect()}
    assert len(got) == 2 * (29 + 28 + 27)
    for i in (0, 7, 14):
        start = rows[i][1]
        for r in cau.granger(pairs.where(F.col("ts") >= start), 3).collect():
            n, p = got[r.feature, start, r.lag]
            assert n == r.n and p == pytest.approx(r.p_value, rel=1e-6)


def test_rows_without_a_fit_stay(spark):
    rows = [("a", float(i), 2.0 * i + 1, i < 6) for i in range(8)] + [("a", None, 3.0, True), ("b", 1.0, 4.0, False)]
    df = spark.createDataFrame(rows, "g string, x double, y double, fit boolean")
    out = models.grouped_least_squares(df, ["g"], ["x"], "y", F.col("fit")).collect()
    assert len(out) == len(rows)
    assert sum(r["predicted"] is None for r in out) == 2
    assert all(abs(r["predicted"] - r["y"]) < 1e-9 for r in out if r["predicted"] is not None)


def test_a_row_of_full_leverage_has_no_distance(spark):
    rows = [(i, float(i), 0.0, float(i % 3)) for i in range(10)] + [(10, 1.0, 1.0, 5.0)]
    out = {r["k"]: r["cooks"] for r in models.cooks_distance(spark.createDataFrame(rows, "k int, a double, b double, y double"), "k", ["a", "b"], "y").collect()}
    assert out[10] is None and all(v is not None for k, v in out.items() if k != 10)


def test_centred_features_give_the_same_model(spark):
    df = spark.createDataFrame([(i, 40 + (i * 7 % 90) / 1000, 3.0 * i) for i in range(50)], "k int, lat double, y double")
    plain, centred = (models.fit(models.linear(), models.assemble(df, ["lat"], "y", ["k"], centre=c)) for c in (False, True))
    assert abs(plain.coefficients[0] - centred.coefficients[0]) < 1e-3 * abs(plain.coefficients[0])
