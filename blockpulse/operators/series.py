"""Operators on long series frames (series_id, ts, value).

Series hold one value per calendar bin, so a series is as long as the calendar, not as the
event tables; windows and arrays per series are bounded by that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from blockpulse.functions.calendar import period_end, period_spine
from blockpulse.operators.aggregates import correlations, found, safe_corr
from blockpulse.operators.windows import in_order


def by_series() -> WindowSpec:
    return Window.partitionBy("series_id")


def in_series() -> WindowSpec:
    return by_series().orderBy("ts")


def to_long(wide: DataFrame, ts: str, columns: Sequence[str]) -> DataFrame:
    as_double = wide.select(F.col(ts).alias("ts"), *[F.col(c).cast("double").alias(c) for c in columns])
    long = as_double.unpivot(["ts"], list(columns), "series_id", "value")
    return long.select("series_id", "ts", F.when(~F.isnan("value"), F.col("value")).alias("value"))


def to_wide(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long.groupBy("ts").pivot("series_id", list(columns)).agg(F.first("value"))


def resample(long: DataFrame, freq: str) -> DataFrame:
    """Mean per calendar bin; bins between the first and last one are kept even when empty."""
    return resample_all(long, [freq]).drop("freq")


def resample_all(long: DataFrame, freqs: Sequence[str]) -> DataFrame:
    """(freq, series_id, ts, value) for several frequencies, from one pass and one aggregation.

    A bin and the empty ones up to the next bin come from the same row, so nothing is joined.
    """
    bins = F.array(*[F.struct(F.lit(f).alias("freq"), period_end(F.col("ts"), f).alias("bin")) for f in freqs])
    means = long.select("series_id", "value", F.inline(bins)).groupBy("freq", "series_id", "bin").agg(F.avg("value").alias("value"))
    after = F.lead("bin").over(Window.partitionBy("freq", "series_id").orderBy("bin"))
    spans = means.withColumn("_after", after)
    until = F.coalesce("_after", "bin")
    spine = F.lit(None).cast("array<date>")
    for f in freqs:
        spine = F.when(F.col("freq") == f, period_spine(F.col("bin"), until, f)).otherwise(spine)
    own = F.filter(spine, lambda d: F.col("_after").isNull() | (d < F.col("_after")))
    filled = spans.select("freq", "series_id", "bin", "value", F.explode(own).alias("ts"))
    return filled.select("freq", "series_id", "ts", F.when(F.col("ts") == F.col("bin"), F.col("value")).alias("value"))


def block_average(long: DataFrame, rows: int) -> DataFrame:
    """Mean of each run of `rows` consecutive present values."""
    present = long.where("value IS NOT NULL")
    block = F.floor((F.row_number().over(in_series()) - 1) / rows).cast("bigint")
    return present.withColumn("block", block).groupBy("series_id", "block").agg(F.avg("value").alias("value"))


def zscore(long: DataFrame, start: date | None = None, by: Sequence[str] = ("series_id",), value: str = "value") -> DataFrame:
    """(x - mean) / sample deviation per group, after `start`; constant groups give NULL."""
    rows = long if start is None else long.where(F.col("ts") > F.lit(start))
    over = Window.partitionBy(*by)
    x = F.col(value)
    varies = F.min(x).over(over) < F.max(x).over(over)
    spread = F.nullif(F.stddev_samp(x).over(over), F.lit(0.0))
    return rows.withColumn(value, F.when(varies, (x - F.avg(x).over(over)) / spread))


def minmax(long: DataFrame) -> DataFrame:
    """Scale to [0, 1]; a series already inside is left alone, a constant one becomes 0."""
    x = F.col("value")
    lo, hi = F.min(x).over(by_series()), F.max(x).over(by_series())
    inside = (lo >= 0) & (hi <= 1)
    scaled = F.when(lo == hi, F.when(x.isNotNull(), 0.0)).otherwise((x - lo) / F.nullif(hi - lo, F.lit(0.0)))
    return long.withColumn("value", F.when(inside, x).otherwise(scaled))


def difference(x: Column, order: int, over: WindowSpec | None = None) -> Column:
    """n-th order difference by the binomial sum of lags (window functions do not nest)."""
    over = over if over is not None else in_series()
    out, sign, ways = x, -1, 1
    for k in range(1, order + 1):
        ways = ways * (order - k + 1) // k
        out = out + sign * ways * F.lag(x, k).over(over)
        sign = -sign
    return out


def diff_n(long: DataFrame, order: int, untouched: Sequence[str] = ()) -> DataFrame:
    """Difference every series except the listed ones; the first `order` rows are dropped."""
    x = F.col("value")
    kept = F.col("series_id").isin(list(untouched)) if untouched else F.lit(False)
    position = F.row_number().over(in_series())
    out = long.withColumns({"_d": F.when(kept, x).otherwise(difference(x, order)), "_pos": position})
    return out.where(F.col("_pos") > order).select("series_id", "ts", F.col("_d").alias("value"))


def shift_features(wide: DataFrame, ts: str, shifts: Mapping[str, int]) -> DataFrame:
    """Move each listed column down by its own number of rows."""
    over = in_order(ts)
    return wide.withColumns({c: F.lag(F.col(c), k).over(over) for c, k in shifts.items()})


def _with_lags(long: DataFrame, lags: Sequence[int], column: str = "value") -> DataFrame:
    """One row per (series, ts, lag) with the value `lag` rows earlier."""
    past = F.array(
        *[F.struct(F.lit(k).cast("int").alias("lag"), F.lag(F.col(column), k).over(in_series()).alias("past")) for k in lags]
    )
    return long.select("series_id", "ts", F.col(column), past.alias("_past")).select(
        "series_id", "ts", column, F.inline("_past")
    )


def autocorr(long: DataFrame, max_lag: int = 7) -> DataFrame:
    """Pearson correlation of each series with its own past."""
    lagged = _with_lags(long, range(1, max_lag + 1))
    return lagged.groupBy("series_id", "lag").agg(safe_corr(F.col("value"), F.col("past")).alias("autocorr"))


def acf(long: DataFrame, max_lag: int) -> DataFrame:
    """Autocorrelation with the global mean and the full sum of squares, lags 0..max_lag."""
    centred = long.where("value IS NOT NULL").withColumn("value", F.col("value") - F.avg("value").over(by_series()))
    lagged = _with_lags(centred, range(0, max_lag + 1))
    total = F.sum(F.col("value") * F.col("value"))
    return lagged.groupBy("series_id", "lag").agg(
        (F.sum(F.col("value") * F.col("past")) / F.nullif(total, F.lit(0.0))).alias("acf")
    )


def seasonal_decompose(long: DataFrame, period: int = 7) -> DataFrame:
    """Additive decomposition by a centred moving average and phase means.

    An even period has no middle row: its average reaches half a period to both sides, and the rows at
    both ends count half.
    """
    half = period // 2
    x = F.col("value")
    frame = in_series().rowsBetween(-half, half)
    if period % 2:
        average = F.avg(x).over(frame)
    else:
        ends = F.lag(x, half).over(in_series()) + F.lead(x, half).over(in_series())
        average = (F.sum(x).over(frame) - ends / 2) / period
    trend = F.when(F.count(x).over(frame) == 2 * half + 1, average)
    rows = long.withColumns({"trend": trend, "phase": (F.row_number().over(in_series()) - 1) % period})
    by_phase = Window.partitionBy("series_id", "phase")
    rows = rows.withColumns({
        "phase_mean": F.avg(x - F.col("trend")).over(by_phase),
        "phase_rows": F.count(F.lit(1)).over(by_phase),
    })
    overall = F.sum(F.col("phase_mean") / F.col("phase_rows")).over(by_series()) / period
    rows = rows.withColumn("seasonal", F.col("phase_mean") - overall)
    return rows.select(
        "series_id", "ts", "value", "trend", "seasonal", (x - F.col("trend") - F.col("seasonal")).alias("residual")
    )


def lag_scan(wide: DataFrame, ts: str, target: str, features: Sequence[str], max_lag: int = 7) -> DataFrame:
    """Correlation of the target with each feature 1..max_lag rows earlier, and the best lag."""
    over = in_order(ts)
    lagged = wide.select(
        F.col(target).alias("_y"),
        *[F.lag(F.col(f), k).over(over).alias(f"{f}@{k}") for f in features for k in range(1, max_lag + 1)],
    )
    pairs = {f"{f}@{k}": (F.col("_y"), F.col(f"`{f}@{k}`")) for f in features for k in range(1, max_lag + 1)}
    one = correlations(lagged, pairs)
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.array(
                *[
                    F.struct(F.lit(k).alias("lag"), found(f"{f}@{k}").alias("correlation"))
                    for k in range(1, max_lag + 1)
                ]
            ).alias("scan"),
        )
        for f in features
    ]
    scans = one.select(F.inline(F.array(*rows)))
    strongest = F.array_max(
        F.transform(
            F.filter("scan", lambda s: s["correlation"].isNotNull()),
            lambda s: F.named_struct(F.lit("size"), F.abs(s["correlation"]), F.lit("minus_lag"), -s["lag"]),
        )
    )
    best = (-strongest["minus_lag"]).alias("best_lag")
    return scans.select("feature", best, F.inline("scan"))


def pre_post_effect(
    panel: DataFrame, groups: Sequence[str], ts: str, response: str, covariate: str, pre_share: float = 0.7
) -> DataFrame:
    """Post-period response against a line fitted on the pre-period, per group.

    Both columns are standardised per group first.
    """
    rows = panel.where(F.col(response).isNotNull() & F.col(covariate).isNotNull())
    rows = zscore(zscore(rows, by=groups, value=response), by=groups, value=covariate)
    over = Window.partitionBy(*groups)
    position = F.row_number().over(over.orderBy(ts)) - 1
    cut = F.floor(F.count(F.lit(1)).over(over) * F.lit(pre_share))
    rows = rows.withColumn("_pre", position <= cut)
    y, x = F.col(response), F.col(covariate)
    pre_y, pre_x = F.when(F.col("_pre"), y), F.when(F.col("_pre"), x)
    post = ~F.col("_pre")
    fitted = rows.groupBy(*groups).agg(
        F.regr_slope(pre_y, pre_x).alias("slope"),
        F.regr_intercept(pre_y, pre_x).alias("intercept"),
        F.count(F.when(post, 1)).alias("post_rows"),
        F.avg(F.when(post, y)).alias("actual"),
        F.avg(F.when(post, x)).alias("_x"),
    )
    predicted = F.col("intercept") + F.col("slope") * F.col("_x")
    return fitted.select(
        *groups, "post_rows", "actual", predicted.alias("counterfactual"), (F.col("actual") - predicted).alias("effect")
    )


def ar_forecast(long: DataFrame, steps: int = 12) -> DataFrame:
    """Forecast of a once-differenced first-order autoregression, `steps` rows ahead, closed form."""
    present = long.where("value IS NOT NULL")
    step = difference(F.col("value"), 1)
    rows = present.withColumn("d", step).withColumn("d1", F.lag("d").over(in_series()))
    fit = rows.groupBy("series_id").agg(
        F.regr_slope("d", "d1").alias("phi"),
        F.regr_intercept("d", "d1").alias("c"),
        F.max_by("value", "ts").alias("last"),
        F.max_by("d", "ts").alias("last_d"),
    )
    h = F.col("step").cast("double")
    phi, c, d0 = F.col("phi"), F.col("c"), F.col("last_d")
    unit_root = F.abs(1 - phi) < 1e-12
    safe_gap = F.when(unit_root, F.lit(1.0)).otherwise(1 - phi)
    mu = c / safe_gap
    moved = h * mu + (d0 - mu) * phi * (1 - F.pow(phi, h)) / safe_gap
    drift = h * d0 + c * h * (h + 1) / 2
    ahead = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    return ahead.select("series_id", "step", (F.col("last") + F.when(unit_root, drift).otherwise(moved)).alias("forecast"))
