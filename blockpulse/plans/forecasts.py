"""Forecasts and effect studies of the tract series."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockpulse.operators import forecasting as fc
from blockpulse.oracle import define
from blockpulse.oracle.regression import least_squares_sql
from blockpulse.plans.panels import rounded
from blockpulse.plans.property_sales import monthly_tract_counts, tract_prices
from blockpulse.plans.registry import query

LONG_ORDER = 6

define(
    "tract_series",
    "SELECT 'price/' || CAST(tract_grp AS VARCHAR) AS series_id, month AS ts, CAST(avg_price AS DOUBLE) AS value FROM tract_price "
    "UNION ALL SELECT feed || '/' || CAST(tract_grp AS VARCHAR), month, CAST(n AS DOUBLE) FROM tract_feeds",
)
define(
    "arima_changes",
    "SELECT *, value - LAG(value) OVER (PARTITION BY series_id ORDER BY ts) AS d, "
    "ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY ts) AS pos FROM tract_series WHERE value IS NOT NULL",
)
define(
    "arima_rows",
    "SELECT *, " + ", ".join(f"LAG(d, {k}) OVER (PARTITION BY series_id ORDER BY ts) AS l{k}" for k in range(1, LONG_ORDER + 1)) + " FROM arima_changes",
)
_steps, _last = least_squares_sql("arima_rows", "series_id", ["pos", "d"], [f"l{k}" for k in range(1, LONG_ORDER + 1)], "d", "TRUE", "arima_long", constant="0.0")
for _name, _sql in _steps:
    define(_name, _sql)
# Each lag keeps a share of its length when those before it are swept out; the product is the determinant.
_shares = " UNION ALL ".join(
    f"SELECT series_id, COALESCE(p.s / NULLIF(o.s, 0), 0) AS share FROM (SELECT series_id, SUM(v{k} * v{k}) AS s FROM arima_long_{k} GROUP BY 1) p "
    f"JOIN (SELECT series_id, SUM(v{k} * v{k}) AS s FROM arima_long_0 GROUP BY 1) o USING (series_id)"
    for k in range(1, LONG_ORDER + 1)
)
define("arima_apart", f"SELECT series_id FROM ({_shares}) GROUP BY 1 HAVING PRODUCT(share) >= {fc.SINGULAR}")
define(
    "arima_noise",
    f"SELECT r.series_id, r.pos, r.d, r.l1 AS d1, p.t AS e1 FROM arima_rows r JOIN {_last} p ON p.series_id = r.series_id AND p.pos = r.pos - 1 "
    f"WHERE r.series_id IN (SELECT series_id FROM arima_rows WHERE l{LONG_ORDER} IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= {fc.LEAST_ROWS * LONG_ORDER}) "
    "AND r.series_id IN (SELECT series_id FROM arima_apart)",
)
_DEPENDENT = f"a * c = 0 OR 1 - b * b / (a * c) < {fc.SINGULAR}"
define(
    "arima_fit",
    f"""
    SELECT series_id, CASE WHEN {_DEPENDENT} THEN NULL ELSE (p * c - q * b) / (a * c - b * b) END AS phi0,
           CASE WHEN {_DEPENDENT} THEN NULL ELSE (a * q - b * p) / (a * c - b * b) END AS theta0
    FROM (SELECT series_id, SUM(d1 * d1) AS a, SUM(d1 * e1) AS b, SUM(e1 * e1) AS c, SUM(d * d1) AS p, SUM(d * e1) AS q
          FROM arima_noise GROUP BY series_id)
    """,
)


def tract_series(spark, sf):
    """(series_id, ts, value): the mean price of every tract bin and the counts of every feed there, by month."""
    group = F.col("tract_grp").cast("string")
    prices = tract_prices(spark, sf).select(F.concat(F.lit("price/"), group).alias("series_id"), F.col("month").alias("ts"), F.col("avg_price").cast("double").alias("value"))
    counts = monthly_tract_counts(spark, sf).select(F.concat("feed", F.lit("/"), group).alias("series_id"), F.col("month").alias("ts"), F.col("n").cast("double").alias("value"))
    return prices.unionAll(counts)


@query(
    "arima_forecast",
    f"""
    WITH RECURSIVE model AS (
      SELECT series_id, LEAST({fc.BOUND}, GREATEST(-{fc.BOUND}, phi0)) AS phi, LEAST({fc.BOUND}, GREATEST(-{fc.BOUND}, theta0)) AS theta,
             CASE WHEN ABS(phi0) > {fc.BOUND} OR ABS(theta0) > {fc.BOUND} THEN 'bounded' ELSE 'fitted' END AS status
      FROM arima_fit WHERE phi0 IS NOT NULL),
    run AS (
      SELECT c.series_id, c.pos, c.d, CAST(0 AS DOUBLE) AS e FROM arima_changes c WHERE c.pos = 2
      UNION ALL
      SELECT c.series_id, c.pos, c.d, c.d - m.phi * r.d - m.theta * r.e
      FROM run r JOIN model m USING (series_id) JOIN arima_changes c ON c.series_id = r.series_id AND c.pos = r.pos + 1),
    last AS (
      SELECT s.series_id, arg_max(s.value, s.pos) AS x, arg_max(r.d, r.pos) AS d, arg_max(r.e, r.pos) AS e
      FROM arima_changes s LEFT JOIN run r USING (series_id, pos) GROUP BY s.series_id),
    ahead AS (
      SELECT l.series_id, 1 AS step, phi * d + theta * e AS dd, x + phi * d + theta * e AS v, phi, theta, status FROM last l JOIN model m USING (series_id)
      UNION ALL SELECT series_id, step + 1, phi * dd, v + phi * dd, phi, theta, status FROM ahead WHERE step < 12)
    SELECT series_id, step, ROUND(v, 2) AS forecast, ROUND(phi, 6) AS phi, ROUND(theta, 6) AS theta, status FROM ahead
    UNION ALL
    SELECT DISTINCT series_id, CAST(unnest(range(1, 13)) AS INTEGER), NULL, NULL, NULL, 'not fitted' FROM tract_series
    WHERE value IS NOT NULL AND series_id NOT IN (SELECT series_id FROM model)
    """,
)
def arima_forecast(spark, sf):
    """Twelve months ahead for every tract bin: its mean price and the counts of every feed."""
    found = fc.arima_forecast(tract_series(spark, sf), 12, LONG_ORDER)
    return found.select("series_id", "step", F.round("forecast", 2).alias("forecast"), F.round("phi", 6).alias("phi"), F.round("theta", 6).alias("theta"), "status")


@query(
    "causal_effect",
    f"""
    WITH RECURSIVE joined AS (
      SELECT feed, tract_grp, month, CAST(n AS DOUBLE) AS n, avg_price FROM tract_price JOIN tract_feeds USING (month, tract_grp) WHERE avg_price IS NOT NULL),
    scaled AS (
      SELECT feed, tract_grp, month,
             CASE WHEN MIN(n) OVER w < MAX(n) OVER w THEN (n - AVG(n) OVER w) / STDDEV_SAMP(n) OVER w END AS y,
             CASE WHEN MIN(avg_price) OVER w < MAX(avg_price) OVER w THEN (avg_price - AVG(avg_price) OVER w) / STDDEV_SAMP(avg_price) OVER w END AS x
      FROM joined WINDOW w AS (PARTITION BY feed, tract_grp)),
    z AS (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY feed, tract_grp ORDER BY month) AS pos, FLOOR(COUNT(*) OVER (PARTITION BY feed, tract_grp) * 0.7) + 1 AS cut
      FROM scaled WHERE x IS NOT NULL AND y IS NOT NULL),
    k AS (
      SELECT DISTINCT feed, tract_grp, unnest([{", ".join(f"CAST({r} AS DOUBLE)" for r in fc.RATIOS)}]) AS q, CAST(0 AS BIGINT) AS pos,
             CAST(0 AS DOUBLE) AS m1, CAST(0 AS DOUBLE) AS m2, CAST({fc.DIFFUSE} AS DOUBLE) AS p11, CAST(0 AS DOUBLE) AS p12,
             CAST({fc.DIFFUSE} AS DOUBLE) AS p22, CAST(0 AS DOUBLE) AS ss, CAST(0 AS DOUBLE) AS sl FROM z
      UNION ALL
      SELECT feed, tract_grp, q, pos, m1 + a * v / f, m2 + b * v / f, p11 - a * a / f, p12 - a * b / f, p22 - b * b / f,
             ss + CASE WHEN pos > 2 THEN v * v / f ELSE 0 END, sl + CASE WHEN pos > 2 THEN ln(f) ELSE 0 END
      FROM (SELECT k.feed, k.tract_grp, k.q, z.pos, k.m1, k.m2, k.p11 + k.q AS p11, k.p12, k.p22, k.ss, k.sl,
                   z.y - k.m1 - z.x * k.m2 AS v, k.p11 + k.q + z.x * k.p12 AS a, k.p12 + z.x * k.p22 AS b,
                   k.p11 + k.q + 2 * z.x * k.p12 + z.x * z.x * k.p22 + 1 AS f
            FROM k JOIN z ON z.feed = k.feed AND z.tract_grp = k.tract_grp AND z.pos = k.pos + 1 AND z.pos <= z.cut)),
    ended AS (SELECT * FROM k QUALIFY ROW_NUMBER() OVER (PARTITION BY feed, tract_grp, q ORDER BY pos DESC) = 1),
    best AS (
      SELECT *, CASE WHEN pos - 2 > 1 THEN ss / (pos - 2) END AS noise FROM ended
      QUALIFY ROW_NUMBER() OVER (PARTITION BY feed, tract_grp
        ORDER BY COALESCE(CASE WHEN pos - 2 > 1 AND ss > 0 THEN -0.5 * ((pos - 2) * ln(ss / (pos - 2)) + sl) END, CAST('-inf' AS DOUBLE)) DESC, q) = 1),
    later AS (
      SELECT z.feed, z.tract_grp, z.month, z.y, z.x, b.q, b.noise, CASE WHEN b.noise IS NOT NULL THEN b.m1 + z.x * b.m2 END AS predicted,
             z.pos - z.cut AS h, SUM(z.x) OVER u AS sx, b.p11, b.p12, b.p22
      FROM z JOIN best b ON z.feed = b.feed AND z.tract_grp = b.tract_grp WHERE z.pos > z.cut
      WINDOW u AS (PARTITION BY z.feed, z.tract_grp ORDER BY z.month)),
    done AS (
      SELECT *, y - predicted AS effect, SUM(y - predicted) OVER (PARTITION BY feed, tract_grp ORDER BY month) AS cumulated,
             {fc.Z95} * sqrt(noise * (p11 + h * q + 2 * x * p12 + x * x * p22 + 1)) AS half,
             {fc.Z95} * sqrt(noise * (h * h * p11 + 2 * h * sx * p12 + sx * sx * p22 + q * h * (h + 1) * (2 * h + 1) / 6 + h)) AS half_total
      FROM later)
    SELECT feed, tract_grp, month, ROUND(y, 4) AS actual, ROUND(predicted, 4) AS predicted, ROUND(predicted - half, 4) AS lower,
           ROUND(predicted + half, 4) AS upper, ROUND(effect, 4) AS effect, ROUND(effect - half, 4) AS effect_lower, ROUND(effect + half, 4) AS effect_upper,
           ROUND(cumulated, 4) AS cumulated, ROUND(cumulated - half_total, 4) AS cumulated_lower, ROUND(cumulated + half_total, 4) AS cumulated_upper, q AS ratio
    FROM done
    """,
)
def causal_effect(spark, sf):
    """Effect of the post-period on the counts of four feeds in six tract bins, with 95 % bounds, month by month."""
    both = tract_prices(spark, sf).join(monthly_tract_counts(spark, sf), ["month", "tract_grp"])
    found = fc.causal_effect(both, ["feed", "tract_grp"], "month", "n", "avg_price")
    return rounded(found)
