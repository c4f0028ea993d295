"""Forecasts with a moving-average term, and effects measured against a state-space counterfactual.

Both work on calendar-sized series: a series is folded once in time order, inside Spark, as an ordered
array. Least squares needs the sums of products of a few lagged columns per series.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockpulse.functions import numeric
from blockpulse.operators.moments import gram
from blockpulse.operators.series import difference, in_series, zscore

#: Both coefficients stay this far inside the unit interval, so that the recursions fade out.
BOUND = 0.99
#: Columns scaled to length one whose products have a determinant below this are taken to depend on each other.
SINGULAR = 1e-10
#: Rows per coefficient that the long autoregression needs.
LEAST_ROWS = 3
#: Ratios of level variance to noise variance that are tried.
RATIOS = (0.0, 1e-4, 3e-4, 1e-3, 3e-3, 0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0)
#: Prior variance of level and coefficient, in standardised units: next to no information.
DIFFUSE = 1e6
#: Half width of a 95 % interval in standard deviations.
Z95 = 1.959963984540054


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _coefficients(grams: pd.Series) -> pd.Series:
    """Coefficients of the last column on the others, from flat sums of products; NULL if singular."""

    def solved(flat) -> list[float] | None:
        size = int(round(len(flat) ** 0.5))
        g = np.asarray(flat, dtype=float).reshape(size, size)
        scale = np.sqrt(np.diag(g)[:-1])
        if not (scale > 0).all() or np.linalg.det(g[:-1, :-1] / np.outer(scale, scale)) < SINGULAR:
            return None
        return numeric.ssr_from_gram(g, list(range(size - 1)), size - 1)[1].tolist()

    return grams.map(solved)


def _regressed(rows: DataFrame, columns: Sequence[Column], target: Column, least: int = 1) -> DataFrame:
    """(series_id, beta): least squares without a constant, per series of `least` rows or more where all are present."""
    vectors = rows.select("series_id", F.array(*[c.cast("double") for c in columns], target).alias("v"))
    complete = vectors.where(~F.exists("v", lambda x: x.isNull()))
    return gram(complete, ["series_id"], "v").where(F.col("n") >= least).select("series_id", _coefficients("gram").alias("beta"))


def arima_forecast(long: DataFrame, steps: int = 12, long_order: int = 6) -> DataFrame:
    """(series_id, step, forecast, phi, theta, status): ARIMA(1,1,1) of every series, `steps` rows ahead.

    Innovations are first estimated by a long autoregression of the differences, and the difference is
    then regressed on its past value and the past innovation. The fitted recursion runs over the whole
    series for the last innovation, and on from there. Coefficients beyond BOUND are moved to it and
    the status says so; a series too short (LEAST_ROWS rows per coefficient of the long autoregression) or
    too plain to be fitted has NULL forecasts.
    """
    present = long.where("value IS NOT NULL").select("series_id", "ts", F.col("value").cast("double").alias("value"))
    changes = present.withColumn("d", difference(F.col("value"), 1))
    past = [F.lag("d", k).over(in_series()) for k in range(1, long_order + 1)]
    changes = changes.withColumn("past", F.array(*past))
    first = _regressed(changes, [F.col("past")[k] for k in range(long_order)], F.col("d"), LEAST_ROWS * long_order).withColumnRenamed("beta", "long_beta")
    fitted = F.aggregate(F.zip_with("past", "long_beta", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    marked = changes.join(first, "series_id", "left").withColumn("e", F.col("d") - fitted)
    marked = marked.withColumns({"d1": F.lag("d").over(in_series()), "e1": F.lag("e").over(in_series())})
    second = _regressed(marked, [F.col("d1"), F.col("e1")], F.col("d"))

    def bounded(c: Column) -> Column:
        return F.when(c.isNotNull(), F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), c)))

    history = F.transform(F.array_sort(F.collect_list(F.when(F.col("d").isNotNull(), F.struct("ts", "d")))), lambda r: r["d"])
    series = changes.groupBy("series_id").agg(history.alias("ds"), F.max_by("value", "ts").alias("last"))
    raw_phi, raw_theta = F.col("beta")[0], F.col("beta")[1]
    model = series.join(second, "series_id", "left").select(
        "series_id", "ds", "last", bounded(raw_phi).alias("phi"), bounded(raw_theta).alias("theta"),
        F.when(F.col("beta").isNull(), "not fitted").when((F.abs(raw_phi) > BOUND) | (F.abs(raw_theta) > BOUND), "bounded").otherwise("fitted").alias("status"),
    )
    phi, theta = F.col("phi"), F.col("theta")

    def innovation(state: Column, d: Column) -> Column:
        return F.struct(d.alias("d"), (d - phi * state["d"] - theta * state["e"]).alias("e"))

    # The first difference has no past; it starts the recursion.
    start = F.struct(F.get("ds", F.lit(0)).alias("d"), F.lit(0.0).alias("e"))
    end = F.aggregate(F.slice("ds", 2, F.greatest(F.lit(1), F.size("ds"))), start, innovation)
    at_end = model.withColumn("end", end)
    one = phi * F.col("end.d") + theta * F.col("end.e")

    def onwards(path: Column, _: Column) -> Column:
        tail = F.element_at(path, -1)
        return F.concat(path, F.array(F.struct((phi * tail["d"]).alias("d"), (tail["x"] + phi * tail["d"]).alias("x"))))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.array(F.struct(one.alias("d"), (F.col("last") + one).alias("x"))), onwards)
    ahead = at_end.select("series_id", "phi", "theta", "status", F.posexplode(F.slice(path, 1, steps)).alias("place", "at"))
    return ahead.select("series_id", (F.col("place") + 1).alias("step"), F.col("at.x").alias("forecast"), "phi", "theta", "status")


def causal_effect(
    panel: DataFrame, groups: Sequence[str], ts: str, response: str, covariate: str, pre_share: float = 0.7, ratios: Sequence[float] = RATIOS
) -> DataFrame:
    """Response after the pre-period against a state-space counterfactual, per group and period.

    The response is a local level plus a constant coefficient times the covariate plus noise. Each
    group's pre-period is filtered once for every ratio of level variance to noise variance; the
    likeliest ratio is kept (the smallest of equals). From the last state the counterfactual of every
    later period has a mean and a variance, as has its running sum. Both columns are standardised per
    group first, over all periods. Groups with fewer than four pre-periods have NULL counterfactuals.

    Returns groups, ts, actual, predicted, lower, upper, effect, effect_lower, effect_upper, cumulated,
    cumulated_lower, cumulated_upper, ratio.
    """
    groups = list(groups)
    rows = panel.where(F.col(response).isNotNull() & F.col(covariate).isNotNull())
    rows = zscore(zscore(rows, by=groups, value=response), by=groups, value=covariate)
    rows = rows.select(*groups, F.col(ts).alias("ts"), F.col(response).alias("y"), F.col(covariate).alias("x")).where("y IS NOT NULL AND x IS NOT NULL")
    ordered = F.array_sort(F.collect_list(F.struct("ts", "x", "y")))
    series = rows.groupBy(*groups).agg(ordered.alias("rows"))
    cut = (F.floor(F.size("rows") * F.lit(pre_share)) + 1).cast("int")
    split = series.select(*groups, F.slice("rows", F.lit(1), cut).alias("pre"), F.slice("rows", cut + 1, F.size("rows")).alias("post"))
    tried = split.withColumn("ratio", F.explode(F.array(*[F.lit(float(r)) for r in ratios])))
    q = F.col("ratio")

    def named(**columns: Column) -> Column:
        return F.struct(*[c.alias(name) for name, c in columns.items()])

    def observe(s: Column, r: Column) -> Column:
        """Predict the level, then learn from one observation; `n` counts those that add to the likelihood."""
        p11, x = s["p11"] + q, r["x"]
        seen = F.array(named(v=r["y"] - s["m1"] - x * s["m2"], a=p11 + x * s["p12"], b=s["p12"] + x * s["p22"], f=p11 + 2 * x * s["p12"] + x * x * s["p22"] + 1))

        def learned(o: Column) -> Column:
            counts = s["seen"] >= 2
            return named(
                m1=s["m1"] + o["a"] * o["v"] / o["f"], m2=s["m2"] + o["b"] * o["v"] / o["f"],
                p11=p11 - o["a"] * o["a"] / o["f"], p12=s["p12"] - o["a"] * o["b"] / o["f"], p22=s["p22"] - o["b"] * o["b"] / o["f"],
                ss=s["ss"] + F.when(counts, o["v"] * o["v"] / o["f"]).otherwise(0.0), sl=s["sl"] + F.when(counts, F.log(o["f"])).otherwise(0.0),
                seen=s["seen"] + 1,
            )

        return F.transform(seen, learned)[0]

    zero = F.lit(0.0)
    begin = named(m1=zero, m2=zero, p11=F.lit(DIFFUSE), p12=zero, p22=F.lit(DIFFUSE), ss=zero, sl=zero, seen=F.lit(0))
    filtered = tried.withColumn("s", F.aggregate("pre", begin, observe))
    n = F.col("s.seen") - 2
    noise = F.when(n > 1, F.col("s.ss") / n)
    likelihood = -0.5 * (n * F.log(F.nullif(noise, F.lit(0.0))) + F.col("s.sl"))
    scored = filtered.select(*groups, "ratio", "s", noise.alias("noise"), F.coalesce(likelihood, F.lit(float("-inf"))).alias("ll"), "post")
    best = scored.groupBy(*groups).agg(F.max_by(F.struct("ratio", "s", "noise", "post"), F.struct("ll", -F.col("ratio"))).alias("best"))
    later = best.select(*groups, "best.ratio", "best.s", "best.noise", F.posexplode("best.post").alias("place", "r"))
    later = later.select(*groups, "ratio", "s", "noise", F.col("r.ts").alias("ts"), F.col("r.x").alias("x"), F.col("r.y").alias("y"), (F.col("place") + 1).cast("double").alias("h"))

    x, y, h = F.col("x"), F.col("y"), F.col("h")
    mean = F.when(F.col("noise").isNotNull(), F.col("s.m1") + x * F.col("s.m2"))
    upto = Window.partitionBy(*groups).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    sum_x = F.sum("x").over(upto)
    one = F.col("s.p11") + h * q + 2 * x * F.col("s.p12") + x * x * F.col("s.p22") + 1
    total = h * h * F.col("s.p11") + 2 * h * sum_x * F.col("s.p12") + sum_x * sum_x * F.col("s.p22") + q * h * (h + 1) * (2 * h + 1) / 6 + h
    with_bounds = later.withColumns({
        "predicted": mean, "effect": y - mean, "half": Z95 * F.sqrt(F.col("noise") * one), "half_total": Z95 * F.sqrt(F.col("noise") * total),
    })
    summed = with_bounds.withColumn("cumulated", F.sum("effect").over(upto))

    def around(c: str, half: str, name: str) -> list[Column]:
        return [(F.col(c) - F.col(half)).alias(f"{name}lower"), (F.col(c) + F.col(half)).alias(f"{name}upper")]

    return summed.select(
        *groups, F.col("ts").alias(ts), y.alias("actual"), "predicted", *around("predicted", "half", ""),
        "effect", *around("effect", "half", "effect_"), "cumulated", *around("cumulated", "half_total", "cumulated_"), "ratio",
    )
