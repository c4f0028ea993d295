"""Resampling, scaling, lags and decomposition of the panel measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockpulse.functions import calendar as cal
from blockpulse.operators import aggregates, filters
from blockpulse.operators import series as ser
from blockpulse.operators import windows as win
from blockpulse.operators.panel import mean_by
from blockpulse.oracle import define
from blockpulse.plans.panels import MEASURES, panel, rounded
from blockpulse.plans.property_sales import monthly_tract_counts, tract_prices
from blockpulse.plans.registry import query

# Monthly signal names and the shifts chosen for them.
SIGNALS = {
    "avg_sales": "avg_price",
    "sales_count": "total_sales",
    "target_ci": "complaints",
    "target_citi": "citibike_rides",
    "target_op": "new_businesses",
    "target_ev": "evictions",
    "target_hi": "avg_health_inspection",
}
FEATURES = [s for s in SIGNALS if s.startswith("target_")]
SHIFTS = {"target_ci": 3, "target_citi": 6, "target_op": 2, "target_ev": 7, "target_hi": 1}
ALL_SIGNALS = list(SIGNALS)

# The test calendar ends in 2001, so the quiet ranges are moved back by this many years.
QUIET_SHIFT = -21
START = date(1997, 1, 1)

_RULES = [r.shifted(QUIET_SHIFT) for r in filters.QUIET_RANGES if r.column in MEASURES]


def signals(spark: SparkSession, sf: str) -> DataFrame:
    """(month, seven monthly signals)."""
    return mean_by(panel(spark, sf), cal.month_start(F.col("event_date")), "month", SIGNALS)


def long_signals(spark: SparkSession, sf: str) -> DataFrame:
    return ser.to_long(signals(spark, sf), "month", ALL_SIGNALS)


def long_panel(spark: SparkSession, sf: str) -> DataFrame:
    return ser.to_long(panel(spark, sf), "event_date", MEASURES)


def _unpivot_sql(source: str, ts: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS series_id, {ts} AS ts, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns
    )


define(
    "signals",
    "SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, "
    + ", ".join(f"AVG({src}) AS {out}" for out, src in SIGNALS.items())
    + " FROM panel GROUP BY 1",
)
define("long_signals", _unpivot_sql("signals", "month", ALL_SIGNALS))
define("long_panel", _unpivot_sql("panel", "event_date", MEASURES))


def quiet_hit_sql(column: str) -> str:
    """Condition of the days on which a measure is not trusted."""
    hits = [
        f"(event_date <= DATE '{r.last}'" + (f" AND event_date >= DATE '{r.first}'" if r.first else "") + ")"
        for r in _RULES
        if r.column == column
    ]
    return " OR ".join(hits) or "FALSE"


def _quiet_sql(column: str) -> str:
    shown = f"ROUND({column}, 4)" if column.startswith("avg_") else column
    return f"CASE WHEN {quiet_hit_sql(column)} THEN NULL ELSE {shown} END AS {column}"


@query("nullify_ranges", "SELECT event_date, " + ", ".join(_quiet_sql(m) for m in MEASURES) + " FROM panel")
def nullify_ranges(spark, sf):
    rules = [r.shifted(QUIET_SHIFT) for r in filters.QUIET_RANGES]
    return rounded(filters.nullify_ranges(panel(spark, sf), "event_date", rules))


@query(
    "resample",
    """
    WITH binned AS (
      SELECT 'W' AS freq, series_id, CAST(date_trunc('week', ts) + INTERVAL 6 DAY AS DATE) AS ts, value FROM long_panel
      UNION ALL SELECT 'M', series_id, last_day(ts), value FROM long_panel
      UNION ALL SELECT 'Q', series_id, last_day(CAST(date_trunc('quarter', ts) + INTERVAL 2 MONTH AS DATE)), value
      FROM long_panel),
    means AS (SELECT freq, series_id, ts, AVG(value) AS value FROM binned GROUP BY ALL),
    ends AS (SELECT freq, series_id, MIN(ts) AS a, MAX(ts) AS b FROM means GROUP BY ALL),
    spine AS (
      SELECT freq, series_id, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS ts FROM ends WHERE freq = 'W'
      UNION ALL SELECT freq, series_id, last_day(CAST(unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH))
        AS DATE)) FROM ends WHERE freq = 'M'
      UNION ALL SELECT freq, series_id, last_day(CAST(unnest(generate_series(date_trunc('month', a), b, INTERVAL 3 MONTH))
        AS DATE)) FROM ends WHERE freq = 'Q')
    SELECT freq, series_id, ts, ROUND(value, 4) AS value FROM spine LEFT JOIN means USING (freq, series_id, ts)
    """,
)
def resample(spark, sf):
    """Weekly (ending Sunday), monthly and quarterly means of every measure."""
    return rounded(ser.resample_all(long_panel(spark, sf), ["W", "M", "Q"]))


@query(
    "block_average",
    """
    SELECT series_id, block, ROUND(AVG(value), 4) AS value
    FROM (SELECT series_id, value, (ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY ts) - 1) // 7 AS block
          FROM long_panel WHERE value IS NOT NULL) GROUP BY 1, 2
    """,
)
def block_average(spark, sf):
    return rounded(ser.block_average(long_panel(spark, sf), 7))


@query(
    "corr_to_target",
    " UNION ALL ".join(f"SELECT '{f}' AS feature, ROUND(corr(avg_sales, {f}), 6) AS correlation FROM signals" for f in ALL_SIGNALS),
)
def corr_to_target(spark, sf):
    return rounded(aggregates.corr_to_target(signals(spark, sf), "avg_sales", ALL_SIGNALS), 6)


@query(
    "shift_features",
    "SELECT month, ROUND(avg_sales, 4) AS avg_sales, "
    + ", ".join(f"ROUND(LAG({c}, {k}) OVER (ORDER BY month), 4) AS {c}" for c, k in SHIFTS.items())
    + " FROM signals",
)
def shift_features(spark, sf):
    shifted = ser.shift_features(signals(spark, sf), "month", SHIFTS)
    return rounded(shifted.select("month", "avg_sales", *SHIFTS))


@query(
    "diff_n",
    """
    SELECT series_id, ts, ROUND(CASE WHEN series_id = 'sales_count' THEN value ELSE d END, 4) AS value
    FROM (SELECT *, value - LAG(value) OVER w AS d, ROW_NUMBER() OVER w AS pos FROM long_signals
          WINDOW w AS (PARTITION BY series_id ORDER BY ts)) WHERE pos > 1
    """,
)
def diff_n(spark, sf):
    """First differences; the sales count is passed through as it is."""
    return rounded(ser.diff_n(long_signals(spark, sf), 1, ["sales_count"]))


@query(
    "diff_second_order",
    """
    SELECT series_id, ts, ROUND(d - LAG(d) OVER (PARTITION BY series_id ORDER BY ts), 4) AS value
    FROM (SELECT series_id, ts, value - LAG(value) OVER (PARTITION BY series_id ORDER BY ts) AS d,
                 ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY ts) AS pos FROM long_signals)
    QUALIFY pos > 2
    """,
)
def diff_second_order(spark, sf):
    return rounded(ser.diff_n(long_signals(spark, sf), 2))


LOOK_BACK = 3


@query(
    "sequence_windows",
    "SELECT month, "
    + ", ".join(
        "["
        + ", ".join(f"ROUND(LAG({f}, {k}) OVER (ORDER BY month), 4)" for k in range(LOOK_BACK, 0, -1))
        + f"] AS {f}_past"
        for f in ("avg_sales", "target_ci")
    )
    + ", ROUND(avg_sales, 4) AS y FROM signals QUALIFY ROW_NUMBER() OVER (ORDER BY month) > "
    + str(LOOK_BACK),
)
def sequence_windows(spark, sf):
    rows = rounded(signals(spark, sf))
    return win.supervised_windows(rows, "month", ["avg_sales", "target_ci"], "avg_sales", LOOK_BACK)


@query(
    "zscore_normalize",
    f"""
    SELECT series_id, ts, ROUND((value - AVG(value) OVER w) / NULLIF(STDDEV_SAMP(value) OVER w, 0), 6) AS value
    FROM long_signals WHERE ts > DATE '{START}' WINDOW w AS (PARTITION BY series_id)
    """,
)
def zscore_normalize(spark, sf):
    return rounded(ser.zscore(long_signals(spark, sf), START), 6)


@query(
    "zscore_by_tract",
    """
    SELECT feed, month, tract_grp, ROUND((n - AVG(n) OVER w) / NULLIF(STDDEV_SAMP(n) OVER w, 0), 6) AS n
    FROM tract_feeds WINDOW w AS (PARTITION BY feed, tract_grp)
    """,
)
def zscore_by_tract(spark, sf):
    """Monthly counts of all four feeds, standardised per feed and tract bin."""
    counts = monthly_tract_counts(spark, sf).select("feed", "month", "tract_grp", "n")
    return rounded(ser.zscore(counts, by=["feed", "tract_grp"], value="n"), 6)


@query(
    "minmax_scale",
    """
    SELECT series_id, ts, ROUND(CASE WHEN lo >= 0 AND hi <= 1 THEN value WHEN lo = hi THEN value * 0
                                     ELSE (value - lo) / (hi - lo) END, 6) AS value
    FROM (SELECT *, MIN(value) OVER (PARTITION BY series_id) AS lo, MAX(value) OVER (PARTITION BY series_id) AS hi
          FROM long_panel)
    """,
)
def minmax_scale(spark, sf):
    return rounded(ser.minmax(long_panel(spark, sf)), 6)


@query(
    "autocorr",
    """
    SELECT series_id, CAST(k AS INTEGER) AS lag, ROUND(corr(value, past), 6) AS autocorr
    FROM (SELECT a.series_id, k, a.value, b.value AS past
          FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY ts) AS pos FROM long_signals) a
          JOIN range(1, 8) r(k) ON TRUE
          JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY ts) AS pos FROM long_signals) b
          ON a.series_id = b.series_id AND b.pos = a.pos - k) GROUP BY 1, 2
    """,
)
def autocorr(spark, sf):
    return rounded(ser.autocorr(long_signals(spark, sf), 7), 6)


ACF_STEPS = """centred AS (SELECT series_id, value - AVG(value) OVER (PARTITION BY series_id) AS v,
                      ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY ts) AS pos
               FROM long_signals WHERE value IS NOT NULL),
    raw_acf AS (SELECT a.series_id, CAST(k AS INTEGER) AS lag,
                       SUM(a.v * b.v) / (SELECT SUM(v * v) FROM centred WHERE centred.series_id = a.series_id) AS acf
                FROM centred a JOIN range(0, 21) r(k) ON TRUE JOIN centred b ON a.series_id = b.series_id AND b.pos = a.pos - k
                GROUP BY 1, 2)"""


@query("acf", f"WITH {ACF_STEPS} SELECT series_id, lag, ROUND(acf, 6) AS acf FROM raw_acf")
def acf(spark, sf):
    return rounded(ser.acf(long_signals(spark, sf), 20), 6)


@query(
    "seasonal_decompose",
    """
    WITH t AS (SELECT *, CASE WHEN COUNT(value) OVER f = 7 THEN AVG(value) OVER f END AS trend,
                      (ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY ts) - 1) % 7 AS phase
               FROM long_signals
               WINDOW f AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    p AS (SELECT series_id, phase, AVG(value - trend) AS m FROM t GROUP BY 1, 2),
    s AS (SELECT series_id, phase, m - AVG(m) OVER (PARTITION BY series_id) AS seasonal FROM p)
    SELECT series_id, ts, ROUND(value, 4) AS value, ROUND(trend, 4) AS trend, ROUND(seasonal, 4) AS seasonal,
           ROUND(value - trend - seasonal, 4) AS residual
    FROM t JOIN s USING (series_id, phase)
    """,
)
def seasonal_decompose(spark, sf):
    return rounded(ser.seasonal_decompose(long_signals(spark, sf), 7))


@query(
    "seasonal_decompose_yearly",
    """
    WITH t AS (SELECT *, CASE WHEN COUNT(value) OVER f = 13
                              THEN (SUM(value) OVER inner_rows + (LAG(value, 6) OVER o + LEAD(value, 6) OVER o) * 0.5) / 12 END AS trend,
                      (ROW_NUMBER() OVER o - 1) % 12 AS phase
               FROM long_signals
               WINDOW o AS (PARTITION BY series_id ORDER BY ts),
                      f AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING),
                      inner_rows AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)),
    p AS (SELECT series_id, phase, AVG(value - trend) AS m FROM t GROUP BY 1, 2),
    s AS (SELECT series_id, phase, m - AVG(m) OVER (PARTITION BY series_id) AS seasonal FROM p)
    SELECT series_id, ts, ROUND(value, 4) AS value, ROUND(trend, 4) AS trend, ROUND(seasonal, 4) AS seasonal,
           ROUND(value - trend - seasonal, 4) AS residual
    FROM t JOIN s USING (series_id, phase)
    """,
)
def seasonal_decompose_yearly(spark, sf):
    """The monthly signals with a season of twelve months, an even period."""
    return rounded(ser.seasonal_decompose(long_signals(spark, sf), 12))


define(
    "scan",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {k} AS lag, corr(avg_sales, p) AS c FROM "
        f"(SELECT avg_sales, LAG({f}, {k}) OVER (ORDER BY month) AS p FROM signals)"
        for f in FEATURES
        for k in range(1, 8)
    ),
)


@query(
    "lag_scan",
    "SELECT feature, FIRST_VALUE(lag) OVER (PARTITION BY feature ORDER BY ABS(c) DESC, lag) AS best_lag, lag, "
    "ROUND(c, 6) AS correlation FROM scan",
)
def lag_scan(spark, sf):
    return rounded(ser.lag_scan(signals(spark, sf), "month", "avg_sales", FEATURES, 7), 6)


@query(
    "shift_gain",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, ROUND(u, 6) AS unshifted, ROUND(s, 6) AS shifted, ROUND(s - u, 6) AS difference FROM "
        f"(SELECT corr(avg_sales, {f}) AS u, corr(avg_sales, p) AS s FROM "
        f"(SELECT avg_sales, {f}, LAG({f}, {k}) OVER (ORDER BY month) AS p FROM signals))"
        for f, k in SHIFTS.items()
    ),
)
def shift_gain(spark, sf):
    """Correlation with the price before and after shifting, from one pass over the signals."""
    both = signals(spark, sf)
    over = win.in_order("month")
    both = both.withColumns({f"{f}_s": F.lag(F.col(f), k).over(over) for f, k in SHIFTS.items()})
    y = F.col("avg_sales")
    one = aggregates.correlations(both, {c: (y, F.col(c)) for f in SHIFTS for c in (f, f"{f}_s")})
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            aggregates.found(f).alias("unshifted"),
            aggregates.found(f"{f}_s").alias("shifted"),
            (aggregates.found(f"{f}_s") - aggregates.found(f)).alias("difference"),
        )
        for f in SHIFTS
    ]
    return rounded(one.select(F.inline(F.array(*rows))), 6)


@query(
    "pre_post_effect",
    """
    WITH z AS (SELECT feed, tract_grp, month, (n - AVG(n) OVER w) / NULLIF(STDDEV_SAMP(n) OVER w, 0) AS y,
                 (avg_price - AVG(avg_price) OVER w) / NULLIF(STDDEV_SAMP(avg_price) OVER w, 0) AS x,
                 ROW_NUMBER() OVER (PARTITION BY feed, tract_grp ORDER BY month) - 1 AS pos, FLOOR(COUNT(*) OVER w * 0.7) AS cut
               FROM tract_price JOIN tract_feeds USING (month, tract_grp) WHERE avg_price IS NOT NULL
               WINDOW w AS (PARTITION BY feed, tract_grp)),
    f AS (SELECT feed, tract_grp, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM z WHERE pos <= cut GROUP BY ALL)
    SELECT feed, tract_grp, COUNT(*) AS post_rows, ROUND(AVG(y), 4) AS actual, ROUND(AVG(a + b * x), 4) AS counterfactual,
           ROUND(AVG(y - (a + b * x)), 4) AS effect
    FROM z JOIN f USING (feed, tract_grp) WHERE pos > cut GROUP BY ALL
    """,
)
def pre_post_effect(spark, sf):
    """The study of all four feeds, per feed and tract bin."""
    both = tract_prices(spark, sf).join(monthly_tract_counts(spark, sf), ["month", "tract_grp"])
    found = ser.pre_post_effect(both, ["feed", "tract_grp"], "month", "n", "avg_price")
    return rounded(found.where("post_rows > 0"))


@query(
    "ar_forecast",
    """
    WITH RECURSIVE base AS (
      SELECT CAST(tract_grp AS VARCHAR) AS series_id, month AS ts, avg_price AS value FROM tract_price
      WHERE avg_price IS NOT NULL),
    d AS (SELECT *, value - LAG(value) OVER (PARTITION BY series_id ORDER BY ts) AS d FROM base),
    e AS (SELECT *, LAG(d) OVER (PARTITION BY series_id ORDER BY ts) AS d1 FROM d),
    fit AS (SELECT series_id, regr_slope(d, d1) AS phi, regr_intercept(d, d1) AS c, arg_max(value, ts) AS x,
                   arg_max(d, ts) AS last_d FROM e GROUP BY 1),
    ahead AS (SELECT series_id, 1 AS step, c + phi * last_d AS dd, x + c + phi * last_d AS v, phi, c FROM fit
              UNION ALL SELECT series_id, step + 1, c + phi * dd, v + c + phi * dd, phi, c FROM ahead WHERE step < 12)
    SELECT series_id, step, ROUND(v, 2) AS forecast FROM ahead
    """,
)
def ar_forecast(spark, sf):
    """Twelve months ahead for the mean price of every tract bin."""
    prices = tract_prices(spark, sf).select(
        F.col("tract_grp").cast("string").alias("series_id"), F.col("month").alias("ts"), F.col("avg_price").alias("value")
    )
    return rounded(ser.ar_forecast(prices, 12), 2)
