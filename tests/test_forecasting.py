"""Forecasts and effects on made series with known answers."""

import numpy as np
import pytest

from blockpulse.operators import forecasting as fc


def long_rows(spark, series):
    return spark.createDataFrame([(name, k, float(v) if v is not None else None) for name, values in series.items() for k, v in enumerate(values)], "series_id string, ts int, value double")


def made_arima(phi, theta, n, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n)
    d = np.zeros(n)
    for t in range(1, n):
        d[t] = phi * d[t - 1] + e[t] + theta * e[t - 1]
    return np.cumsum(d)


def slow_forecast(values, steps, phi, theta):
    d, e = np.diff(values), 0.0
    for t in range(1, len(d)):
        e = d[t] - phi * d[t - 1] - theta * e
    out, change = [], phi * d[-1] + theta * e
    for _ in range(steps):
        out.append((out[-1] if out else values[-1]) + change)
        change *= phi
    return out


def test_arima_finds_the_coefficients_and_goes_on(spark):
    made = {f"{phi}/{theta}": made_arima(phi, theta, 3000, k) for k, (phi, theta) in enumerate([(0.6, 0.3), (-0.4, 0.5), (0.5, -0.3)])}
    found = fc.arima_forecast(long_rows(spark, made), steps=5, long_order=12).orderBy("step").collect()
    for name, values in made.items():
        own = [r for r in found if r.series_id == name]
        phi, theta = map(float, name.split("/"))
        assert own[0].status == "fitted" and own[0].phi == pytest.approx(phi, abs=0.08) and own[0].theta == pytest.approx(theta, abs=0.08)
        assert [r.forecast for r in own] == pytest.approx(slow_forecast(values, 5, own[0].phi, own[0].theta), abs=1e-6)


def test_arima_of_plain_and_short_series(spark):
    series = {"constant": [5] * 40, "short": [1, 2, 4], "one": [3], "line": list(range(40)), "gaps": [None, 1, None, *made_arima(0.5, 0.2, 80, 5)]}
    found = {}
    for r in fc.arima_forecast(long_rows(spark, series), steps=2).collect():
        found.setdefault(r.series_id, []).append(r)
    assert set(found) == set(series) and all(len(rows) == 2 for rows in found.values())
    assert all(r.status == "not fitted" and r.forecast is None for name in ("constant", "short", "one", "line") for r in found[name])
    assert found["gaps"][0].forecast is not None


def slow_effect(y, x, cut, ratio):
    """Bounds by the joint normal distribution of all periods, without a filter."""
    n, m = len(y), cut
    level = fc.DIFFUSE + ratio * (1 + np.minimum.outer(np.arange(n), np.arange(n)))
    cov = level + fc.DIFFUSE * np.outer(x, x) + np.eye(n)
    inside = np.linalg.inv(cov[:m, :m])
    mean = cov[m:, :m] @ inside @ y[:m]
    rest = cov[m:, m:] - cov[m:, :m] @ inside @ cov[:m, m:]
    return mean, np.diag(rest), [np.ones(h) @ rest[:h, :h] @ np.ones(h) for h in range(1, n - m + 1)]


@pytest.mark.parametrize("ratio", [0.0, 0.1])
def test_effect_matches_the_joint_distribution(spark, monkeypatch, ratio):
    monkeypatch.setattr(fc, "DIFFUSE", 100.0)  # so that the direct version can invert its matrix
    rng = np.random.default_rng(8)
    x = rng.normal(size=60)
    y = 0.7 * x + np.cumsum(rng.normal(size=60) * 0.2) + rng.normal(size=60) * 0.5
    y[45:] += 3
    rows = spark.createDataFrame([("g", k, float(a), float(b)) for k, (a, b) in enumerate(zip(y, x))], "g string, t int, y double, x double")
    found = fc.causal_effect(rows, ["g"], "t", "y", "x", ratios=[ratio]).orderBy("t").collect()
    zy, zx = (y - y.mean()) / y.std(ddof=1), (x - x.mean()) / x.std(ddof=1)
    cut = int(60 * 0.7) + 1
    mean, one, total = slow_effect(zy, zx, cut, ratio)
    assert [r.t for r in found] == list(range(cut, 60))
    assert [r.predicted for r in found] == pytest.approx(mean, abs=2e-4)
    # Both give variances up to the noise variance, which is the same for all.
    widths = np.array([(r.upper - r.lower) ** 2 for r in found])
    assert widths / widths[0] == pytest.approx(one / one[0], rel=1e-3)
    totals = np.array([(r.cumulated_upper - r.cumulated_lower) ** 2 for r in found])
    assert totals / widths[0] == pytest.approx(np.array(total) / one[0], rel=1e-3)
    assert [r.cumulated for r in found] == pytest.approx(np.cumsum([r.actual - r.predicted for r in found]))


def test_effect_finds_a_step_and_leaves_short_groups_null(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(80):
        x = float(rng.normal())
        rows += [("step", k, 2 * x + float(rng.normal()) * 0.3 + (4 if k > 60 else 0), x), ("none", k, 2 * x + float(rng.normal()) * 0.3, x)]
    rows += [("short", k, float(k % 3), float(k)) for k in range(4)] + [("flat", k, 1.0, float(k)) for k in range(30)] + [("null", 1, None, 1.0)]
    found = fc.causal_effect(spark.createDataFrame(rows, "g string, t int, y double, x double"), ["g"], "t", "y", "x").orderBy("t").collect()
    last = {r.g: r for r in found}
    assert last["step"].cumulated_lower > 0 and last["none"].cumulated_lower < 0 < last["none"].cumulated_upper
    assert last["short"].predicted is None and set(last) == {"step", "none", "short"}
