"""Causality and unit-root studies of the monthly signals and the tract panel."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockpulse.operators import causality as cau
from blockpulse.operators import filters
from blockpulse.operators import series as ser
from blockpulse.operators.windows import in_order
from blockpulse.oracle import define
from blockpulse.oracle.regression import adf_sql, difference_sql, granger_sql, least_squares_sql
from blockpulse.plans.panels import MEASURES, panel, rounded
from blockpulse.plans.property_sales import monthly_tract_counts, tract_prices
from blockpulse.plans.registry import query
from blockpulse.plans.series import (
    ACF_STEPS as _ACF_STEPS,
)
from blockpulse.plans.series import FEATURES, QUIET_SHIFT, SHIFTS, long_signals, quiet_hit_sql, signals

TARGET = "avg_sales"
PRICE = "avg_price"
MAX_LAG = 11
START_LAGS = 11
TRACT_LAGS = 10
TRACT_GROUPS = list(range(1, 7))
CUTOFFS = {f: d.replace(year=d.year + QUIET_SHIFT) for f, d in filters.FEATURE_CUTOFFS.items()}


def signal_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = cau.paired(long_signals(spark, sf), TARGET)
    return filters.cutoff_by_feature(pairs, "feature", "ts", CUTOFFS)


define(
    "signal_pairs",
    f"""SELECT a.series_id AS feature, a.ts, a.value AS x, b.value AS y
    FROM long_signals a JOIN long_signals b ON a.ts = b.ts AND b.series_id = '{TARGET}'
    WHERE a.series_id <> '{TARGET}' AND a.value IS NOT NULL AND b.value IS NOT NULL """
    + " ".join(f"AND (a.series_id <> '{f}' OR a.ts < DATE '{d}')" for f, d in CUTOFFS.items()),
)
define(
    "scaled_pairs",
    """SELECT feature, ts, (x - AVG(x) OVER w) / STDDEV_SAMP(x) OVER w AS x, (y - AVG(y) OVER w) / STDDEV_SAMP(y) OVER w AS y
    FROM signal_pairs WINDOW w AS (PARTITION BY feature)""",
)


def _materialised(steps: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in steps) + "\n" + body


_STEPS, _GRANGER = granger_sql("scaled_pairs", "feature", list(range(1, MAX_LAG + 1)), "g")


@query("cutoff_by_feature", "SELECT feature, ts, ROUND(x, 4) AS x, ROUND(y, 4) AS y FROM signal_pairs")
def cutoff_by_feature(spark, sf):
    return rounded(signal_pairs(spark, sf).select("feature", "ts", "x", "y"))


@query(
    "granger",
    _materialised(
        _STEPS, f"SELECT feature, lag, n, ROUND(f, 4) AS f_stat, ROUND(p, 6) AS p_value FROM ({_GRANGER})"
    ),
)
def granger(spark, sf):
    """Does a monthly signal lead the average price? F test per signal and lag."""
    tests = cau.granger(signal_pairs(spark, sf), MAX_LAG)
    return tests.select("feature", "lag", "n", F.round("f_stat", 4).alias("f_stat"), F.round("p_value", 6).alias("p_value"))


define("reversed_pairs", "SELECT feature, ts, y AS x, x AS y FROM scaled_pairs")
_REVERSE_STEPS, _REVERSE = granger_sql("reversed_pairs", "feature", list(range(1, MAX_LAG + 1)), "rg")


@query(
    "granger_reverse",
    _materialised(
        _REVERSE_STEPS, f"SELECT feature, lag, n, ROUND(f, 4) AS f_stat, ROUND(p, 6) AS p_value FROM ({_REVERSE})"
    ),
)
def granger_reverse(spark, sf):
    """The opposite direction: does the price lead the signal?"""
    swapped = signal_pairs(spark, sf).select("feature", "ts", F.col("y").alias("x"), F.col("x").alias("y"))
    tests = cau.granger(swapped, MAX_LAG)
    return tests.select("feature", "lag", "n", F.round("f_stat", 4).alias("f_stat"), F.round("p_value", 6).alias("p_value"))


@query(
    "causality_table",
    _materialised(
        _STEPS,
        "SELECT feature, "
        + ", ".join(
            f"ROUND(MAX(p) FILTER (lag = {k}), 6) AS lag_{k}, ROUND(MAX(p) FILTER (lag = {k}), 6) < 0.05 AS lag_{k}_significant"
            for k in range(1, MAX_LAG + 1)
        )
        + f" FROM ({_GRANGER}) GROUP BY 1",
    ),
)
def causality_table(spark, sf):
    return cau.causality_table(cau.granger(signal_pairs(spark, sf), MAX_LAG), MAX_LAG)


def tract_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Count (x) and mean price (y) per month, feed and one of the first six tract bins."""
    counts = monthly_tract_counts(spark, sf).where(F.col("tract_grp").isin(TRACT_GROUPS))
    both = tract_prices(spark, sf).where("avg_price IS NOT NULL").join(counts, ["month", "tract_grp"])
    return both.select("feed", "tract_grp", F.col("month").alias("ts"), F.col("n").cast("double").alias("x"), F.col("avg_price").alias("y"))


define(
    "tract_pairs",
    """SELECT feed, tract_grp, month AS ts, COALESCE((n - AVG(n) OVER w) / NULLIF(STDDEV_SAMP(n) OVER w, 0), 0) AS x,
    COALESCE((avg_price - AVG(avg_price) OVER w) / NULLIF(STDDEV_SAMP(avg_price) OVER w, 0), 0) AS y
    FROM tract_price JOIN tract_feeds USING (month, tract_grp) WHERE tract_grp <= 6 AND avg_price IS NOT NULL
    WINDOW w AS (PARTITION BY feed, tract_grp)""",
)
_TRACT_STEPS, _TRACT_GRANGER = granger_sql("tract_pairs", "feed, tract_grp", list(range(1, TRACT_LAGS + 1)), "tg")


@query(
    "granger_by_group",
    _materialised(
        _TRACT_STEPS, f"SELECT feed, tract_grp, lag, n, ROUND(f, 4) AS f_stat, ROUND(p, 6) AS p_value FROM ({_TRACT_GRANGER})"
    ),
)
def granger_by_group(spark, sf):
    """Does a feed's count lead the price? F test per feed, tract bin and lag, for all four feeds."""
    tests = cau.granger(tract_pairs(spark, sf), TRACT_LAGS, ["feed", "tract_grp"])
    return tests.select("feed", "tract_grp", "lag", "n", F.round("f_stat", 4).alias("f_stat"), F.round("p_value", 6).alias("p_value"))


# --- unit root -------------------------------------------------------------------------------


ADF_LAGS = 12  # lags that eighty months allow


def _orders(source: str, orders: int) -> list[tuple[str, str]]:
    return [(f"{source}_orders", " UNION ALL ".join(difference_sql(source, k) for k in range(orders + 1)))]


def _first_differenced(source: str, name: str) -> str:
    return (
        f"SELECT series_id, ts, CASE WHEN series_id = '{name}' THEN value - LAG(value) OVER (PARTITION BY series_id ORDER BY ts) "
        f"ELSE value END AS value FROM {source}"
    )


def _steady_sql(source: str, prefix: str) -> list[tuple[str, str]]:
    """Steps ending in `<prefix>_steady`: each series at the first order that passes the test."""
    steps, test = adf_sql(f"{source}_orders", 'series_id, "order"', ADF_LAGS, prefix)
    return [
        *_orders(source, cau.MAX_ORDER),
        *steps,
        (
            f"{prefix}_needed",
            f'SELECT series_id, COALESCE(MIN(CASE WHEN p_value < 0.05 THEN "order" END), CASE WHEN COUNT(p_value) > 0 '
            f'THEN {cau.MAX_ORDER} ELSE 0 END) AS "order", '
            f"CASE WHEN COUNT(p_value) > 0 THEN MIN(p_value) < 0.05 END AS stationary FROM {test} GROUP BY 1",
        ),
        (f"{prefix}_steady", f'SELECT * FROM {source}_orders JOIN {prefix}_needed USING (series_id, "order")'),
    ]


def probed_signals(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly signals, and three series of the same months that cannot be tested."""
    long = long_signals(spark, sf)
    month = F.months_between("ts", F.lit(date(1990, 1, 1)))
    probes = F.array(
        F.struct(F.lit("probe_constant").alias("series_id"), F.lit(1.0).alias("value")),
        F.struct(F.lit("probe_line").alias("series_id"), F.round(month).alias("value")),
        F.struct(F.lit("probe_short").alias("series_id"), F.when(F.col("place") <= 3, F.round(month) ** 2).alias("value")),
    )
    months = long.where(F.col("series_id") == TARGET).withColumn("place", F.row_number().over(in_order("ts")))
    extra = months.select("ts", F.inline(probes)).where("value IS NOT NULL")
    return long.unionByName(extra)


_MONTH_NUMBER = "(year(ts) - 1990) * 12 + month(ts) - 1"
define(
    "probed_signals",
    f"""SELECT series_id, ts, value FROM long_signals
    UNION ALL SELECT 'probe_constant', ts, 1.0 FROM long_signals WHERE series_id = '{TARGET}'
    UNION ALL SELECT 'probe_line', ts, {_MONTH_NUMBER} FROM long_signals WHERE series_id = '{TARGET}'
    UNION ALL (SELECT 'probe_short', ts, ({_MONTH_NUMBER}) ** 2 FROM long_signals WHERE series_id = '{TARGET}' ORDER BY ts LIMIT 3)""",
)
_ADF_STEPS, _ADF_TEST = adf_sql("probed_signals_orders", 'series_id, "order"', ADF_LAGS, "adf")


@query(
    "adf_test",
    _materialised(
        [*_orders("probed_signals", 1), *_ADF_STEPS],
        'SELECT series_id, "order", used_lag, n, ROUND(statistic, 6) AS statistic, ROUND(p_value, 6) AS p_value, status '
        f"FROM {_ADF_TEST}",
    ),
)
def adf_test(spark, sf):
    """Unit-root test of every monthly signal and of its first difference; untestable series stay."""
    options = cau.differenced_orders(probed_signals(spark, sf), 1).where("value IS NOT NULL")
    tests = cau.adf_test(options, ["series_id", "order"])
    return rounded(tests, 6)


@query(
    "make_stationary",
    _materialised(
        [("citi_signals", _first_differenced("probed_signals", "target_citi")), *_steady_sql("citi_signals", "ms")],
        'SELECT series_id, "order", ts, ROUND(value, 4) AS value, stationary FROM ms_steady',
    ),
)
def make_stationary(spark, sf):
    return rounded(cau.make_stationary(probed_signals(spark, sf), ["target_citi"]))


def preprocessed(spark: SparkSession, sf: str, freq: str = "M") -> DataFrame:
    """Quiet ranges removed, resampled, differenced until stationary, standardised."""
    rules = [r.shifted(QUIET_SHIFT) for r in filters.QUIET_RANGES]
    days = filters.nullify_ranges(panel(spark, sf), "event_date", rules)
    binned = ser.resample(ser.to_long(days, "event_date", MEASURES), freq)
    steady = cau.make_stationary(binned, ["citibike_rides"]).drop("order", "stationary")
    return ser.zscore(steady, date(1996, 1, 1))


define(
    "quiet_long",
    " UNION ALL ".join(
        f"SELECT '{m}' AS series_id, event_date AS ts, CAST(CASE WHEN {quiet_hit_sql(m)} THEN NULL ELSE {m} END AS DOUBLE) AS value FROM panel"
        for m in MEASURES
    ),
)


_PREPROCESS_STEPS = [
    ("pp_months", "SELECT series_id, last_day(ts) AS ts, AVG(value) AS value FROM quiet_long GROUP BY 1, 2"),
    ("pp_months_rides", _first_differenced("pp_months", "citibike_rides")),
    *_steady_sql("pp_months_rides", "pp"),
    (
        "pp_scaled",
        """SELECT series_id, ts, (value - AVG(value) OVER w) / NULLIF(STDDEV_SAMP(value) OVER w, 0) AS value
        FROM pp_steady WHERE ts > DATE '1996-01-01' WINDOW w AS (PARTITION BY series_id)""",
    ),
]


@query("preprocess", _materialised(_PREPROCESS_STEPS, "SELECT series_id, ts, ROUND(value, 6) AS value FROM pp_scaled"))
def preprocess(spark, sf):
    return rounded(preprocessed(spark, sf, "M"), 6)


# --- start search ----------------------------------------------------------------------------

_START_TESTS, _START_GRANGER = granger_sql("start_pairs", "feature, start", list(range(1, START_LAGS + 1)), "sg")
_START_STEPS = [
    *_PREPROCESS_STEPS,
    (
        "steady_pairs",
        f"""SELECT a.series_id AS feature, a.ts, a.value AS x, b.value AS y FROM pp_scaled a
        JOIN pp_scaled b ON a.ts = b.ts AND b.series_id = '{PRICE}' WHERE a.series_id <> '{PRICE}' AND a.value IS NOT NULL AND b.value IS NOT NULL""",
    ),
    (
        "steady_scaled",
        """SELECT feature, ts, COALESCE((x - AVG(x) OVER w) / NULLIF(STDDEV_SAMP(x) OVER w, 0), 0) AS x,
        COALESCE((y - AVG(y) OVER w) / NULLIF(STDDEV_SAMP(y) OVER w, 0), 0) AS y FROM steady_pairs WINDOW w AS (PARTITION BY feature)""",
    ),
    (
        "start_pairs",
        """SELECT s.feature AS feature, s.ts AS start, p.ts, p.x, p.y FROM steady_scaled s
        JOIN steady_scaled p ON p.feature = s.feature AND p.ts >= s.ts""",
    ),
    *_START_TESTS,
    ("start_p", f"SELECT * REPLACE (ROUND(p, 6) AS p) FROM ({_START_GRANGER})"),
]


def _starts(spark, sf, max_lag: int = START_LAGS) -> DataFrame:
    """Every start date of every preprocessed monthly measure, tested against the price."""
    starts = cau.granger_starts(cau.paired(preprocessed(spark, sf, "M"), PRICE), max_lag)
    return starts.withColumn("p_value", F.round("p_value", 6))


@query(
    "granger_start_search",
    _materialised(
        [
            *_START_STEPS,
            ("mean_start", "SELECT feature, start, AVG(p) AS mean_p FROM start_p GROUP BY 1, 2 HAVING AVG(p) IS NOT NULL"),
            ("best", "SELECT * FROM mean_start QUALIFY ROW_NUMBER() OVER (PARTITION BY feature ORDER BY mean_p, start) = 1"),
        ],
        "SELECT feature, start, lag, n, p AS p_value, ROUND(mean_p, 9) AS mean_p FROM start_p JOIN best USING (feature, start)",
    ),
)
def granger_start_search(spark, sf):
    """Start date with the smallest mean p-value per signal, and its p-values."""
    best = cau.best_start(_starts(spark, sf))
    return best.select("feature", "start", "lag", "n", "p_value", F.round("mean_p", 9).alias("mean_p"))


@query(
    "argmin_per_group",
    _materialised(
        [
            *_START_STEPS,
            ("mean_start", "SELECT feature, start, AVG(p) AS mean_p FROM start_p GROUP BY 1, 2 HAVING AVG(p) IS NOT NULL"),
        ],
        "SELECT feature, start, ROUND(mean_p, 9) AS mean_p FROM mean_start "
        "QUALIFY ROW_NUMBER() OVER (PARTITION BY feature ORDER BY mean_p, start) = 1",
    ),
)
def argmin_per_group(spark, sf):
    summary = cau.start_summary(_starts(spark, sf)).where("mean_p IS NOT NULL")
    best = summary.groupBy("feature").agg(F.min(F.struct("mean_p", "start")).alias("b"))
    return best.select("feature", "b.start", F.round("b.mean_p", 9).alias("mean_p"))


@query(
    "significant_lag_count",
    _materialised(
        _START_STEPS,
        "SELECT feature, start, ROUND(AVG(p), 9) AS mean_p, COUNT(*) FILTER (p < 0.05) AS significant_lags "
        "FROM start_p GROUP BY 1, 2",
    ),
)
def significant_lag_count(spark, sf):
    return rounded(cau.start_summary(_starts(spark, sf)), 9)



@query(
    "pacf",
    f"""
    WITH RECURSIVE {_ACF_STEPS},
    curve AS (SELECT series_id, list(acf ORDER BY lag) AS r FROM raw_acf GROUP BY 1),
    level AS (
      SELECT series_id, r, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1 AS DOUBLE) AS v, CAST(1 AS DOUBLE) AS p FROM curve
      UNION ALL
      SELECT series_id, r, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - a * phi[k + 1 - j]), a),
             v * (1 - a * a), a
      FROM (SELECT *, (r[k + 2] - COALESCE(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])), 0)) / v AS a
            FROM level WHERE k < 20))
    SELECT series_id, CAST(k AS INTEGER) AS lag, ROUND(p, 6) AS pacf FROM level
    """,
)
def pacf(spark, sf):
    return rounded(cau.pacf(ser.acf(long_signals(spark, sf), 20)), 6)


_SHIFT_NAMES = [f"s_{f}" for f in FEATURES]
_SHIFT_STEPS, _SHIFT_LAST = least_squares_sql(
    "shifted_rows", ", ".join(_SHIFT_NAMES), [], [f"x_{f}" for f in FEATURES], TARGET, "share <= 0.8", "os"
)


def _shift_sql() -> str:
    """Every combination of shifts joined to the months on which all lags exist, one fit per combination."""
    lags = [(f, k) for f in FEATURES for k in (range(1, 8) if f != FEATURES[-1] else [SHIFTS[f]])]
    lagged = ", ".join(f"LAG({f}, {k}) OVER (ORDER BY month) AS {f}_{k}" for f, k in lags)
    present = " AND ".join([*[f"{f}_{k} IS NOT NULL" for f, k in lags], f"{TARGET} IS NOT NULL"])
    free = FEATURES[:-1]
    grid = "SELECT " + ", ".join(f"g{i}.k AS s_{f}" for i, f in enumerate(free)) + f", {SHIFTS[FEATURES[-1]]} AS s_{FEATURES[-1]} FROM "
    grid += ", ".join(f"range(1, 8) g{i}(k)" for i in range(len(free)))
    picks = ", ".join(
        "CASE s_{f} ".format(f=f) + " ".join(f"WHEN {k} THEN {f}_{k}" for g, k in lags if g == f) + f" END AS x_{f}" for f in FEATURES
    )
    steps = [
        ("lagged_rows", f"SELECT month, {TARGET}, {lagged} FROM signals"),
        ("shared_rows", f"SELECT *, PERCENT_RANK() OVER (ORDER BY month) AS share FROM lagged_rows WHERE {present}"),
        ("shift_grid", grid),
        ("shifted_rows", f"SELECT {', '.join(_SHIFT_NAMES)}, share, {TARGET}, {picks} FROM shared_rows JOIN shift_grid ON TRUE"),
        *_SHIFT_STEPS,
    ]
    shown = ", ".join(f"CAST(s_{f} AS INTEGER) AS {f}" for f in FEATURES)
    return _materialised(steps, f"SELECT {shown}, ROUND(AVG(ABS(t)) FILTER (NOT tr), 4) AS mae FROM {_SHIFT_LAST} GROUP BY {', '.join(_SHIFT_NAMES)}")


@query("optimize_shifts", _shift_sql())
def optimize_shifts(spark, sf):
    """Test error of a linear model for every combination of feature shifts; the smallest is the choice."""
    grid = cau.optimize_shifts(signals(spark, sf), "month", TARGET, FEATURES, {FEATURES[-1]: SHIFTS[FEATURES[-1]]})
    return rounded(grid)
