"""Tail probabilities and tiny dense solves used on pre-aggregated moments.

Every function works on a handful of numbers per call; the rows behind those numbers are
aggregated by Spark before they get here.
"""

from __future__ import annotations

import math

import numpy as np


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b) by Lentz's continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    floor = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > floor else floor)
    fraction = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for numerator in (even, odd):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > floor else floor)
            c = 1.0 + numerator / c
            c = c if abs(c) > floor else floor
            step = c * d
            fraction *= step
        if abs(step - 1.0) < 1e-15:
            break
    return front * fraction


def f_upper_tail(f: float, d1: float, d2: float) -> float:
    """P(F(d1, d2) > f)."""
    if not (math.isfinite(f) and d2 > 0):
        return math.nan
    if f <= 0:
        return 1.0
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


# Published response surface of the unit-root statistic with a constant term.
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_SWITCH = -1.61
ADF_MAX = 2.74
ADF_MIN = -18.83


def adf_pvalue(t: float) -> float:
    if not math.isfinite(t):
        return math.nan
    if t > ADF_MAX:
        return 1.0
    if t < ADF_MIN:
        return 0.0
    terms = ADF_SMALL if t <= ADF_SWITCH else ADF_LARGE
    return normal_cdf(sum(c * t**k for k, c in enumerate(terms)))


def ssr_from_gram(gram: np.ndarray, regressors: list[int], target: int) -> tuple[float, np.ndarray]:
    """Residual sum of squares and coefficients of target on regressors, from cross products.

    Columns are scaled to unit length first; a singular system gives NaN.
    """
    g = gram[np.ix_(regressors, regressors)]
    rhs = gram[regressors, target]
    scale = np.sqrt(np.diag(g))
    if np.any(scale <= 0):
        return math.nan, np.full(len(regressors), math.nan)
    unit = g / np.outer(scale, scale)
    if np.linalg.cond(unit) > 1e13:
        return math.nan, np.full(len(regressors), math.nan)
    beta = np.linalg.solve(unit, rhs / scale) / scale
    ssr = gram[target, target] - 2 * beta @ rhs + beta @ g @ beta
    return max(float(ssr), 0.0), beta


def granger_f(gram: np.ndarray, n: int, lags: int) -> tuple[float, float]:
    """F statistic and p-value for columns [1, effect lags, cause lags, effect]."""
    target = 2 * lags + 1
    restricted, _ = ssr_from_gram(gram, list(range(lags + 1)), target)
    full, _ = ssr_from_gram(gram, list(range(2 * lags + 1)), target)
    dof = n - 2 * lags - 1
    if dof <= 0 or not (math.isfinite(restricted) and math.isfinite(full)) or full <= 0:
        return math.nan, math.nan
    f = max(restricted - full, 0.0) / lags / (full / dof)
    return f, f_upper_tail(f, lags, dof)


def adf_best_lag(gram: np.ndarray, n: int, max_lag: int) -> int:
    """Lag count with the smallest AIC for columns [1, level, d1..dK, d], one common sample."""
    target = max_lag + 2
    scores = []
    for k in range(max_lag + 1):
        ssr, _ = ssr_from_gram(gram, list(range(k + 2)), target)
        if math.isfinite(ssr) and ssr > 0:
            scores.append((n * math.log(ssr / n) + 2 * (k + 2), k))
    return min(scores)[1] if scores else -1


def adf_statistic(gram: np.ndarray, n: int, lags: int) -> float:
    """t statistic of the lagged level for columns [1, level, d1..dk, d]."""
    target = lags + 2
    used = list(range(lags + 2))
    ssr, beta = ssr_from_gram(gram, used, target)
    dof = n - len(used)
    if dof <= 0 or not math.isfinite(ssr) or ssr <= 0:
        return math.nan
    inverse = np.linalg.inv(gram[np.ix_(used, used)])
    return float(beta[1] / math.sqrt(ssr / dof * inverse[1, 1]))


def partial_autocorrelations(acf: list[float]) -> list[float]:
    """Durbin-Levinson recursion over r0..rK; returns values for lags 0..K."""
    out, phi, v = [1.0], np.zeros(0), 1.0
    for k in range(1, len(acf)):
        past = np.asarray(acf[1:k][::-1])
        a = (acf[k] - float(phi @ past)) / v if v > 0 else math.nan
        phi = np.append(phi - a * phi[::-1], a)
        v *= 1.0 - a * a
        out.append(a)
    return out
