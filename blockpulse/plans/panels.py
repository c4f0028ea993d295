"""Daily and weekly panels and the per-feed counts behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockpulse.fixtures import LINE_FEEDS, feed, line_events, order_events, table
from blockpulse.functions import calendar as cal
from blockpulse.operators import aggregates, filters
from blockpulse.operators.panel import Feed, aligned_panel, tagged_events
from blockpulse.oracle import define
from blockpulse.plans.registry import query

# The measures of the daily panel, in output order.
MEASURES = [
    "avg_price",
    "total_sales",
    "complaints",
    "new_businesses",
    "evictions",
    "new_restaurants",
    "avg_health_inspection",
    "total_inspections",
    "num_arrests",
    "jobs_filed",
    "citibike_rides",
]
# The ten measures of the monthly analysis (rides are left out there).
CORE_MEASURES = MEASURES[:-1]


# Panel columns of the counted line feeds.
_COUNT_NAMES = {
    "complaints": "complaints",
    "businesses": "new_businesses",
    "evictions": "evictions",
    "restaurants": "new_restaurants",
}


def line_feeds(spark: SparkSession, sf: str) -> list[Feed]:
    """Five feeds that are slices of one event table."""
    rows, where = line_events(spark, sf)
    day = F.col("date")
    counted = [Feed(n, rows, day, count_as=c, where=where[n]) for n, c in _COUNT_NAMES.items()]
    inspections = Feed(
        "health_inspections", rows, day, "total_inspections", "avg_health_inspection",
        measure=F.col("score"), where=where["health_inspections"],
    )
    return [*counted, inspections]


def order_feeds(spark: SparkSession, sf: str) -> list[Feed]:
    """Sales, arrests and filings: three feeds of one table, each by its own date."""
    rows, where = order_events(spark, sf)
    return [
        Feed("sales", rows, F.col("sale_date"), "total_sales", "avg_price", measure=F.col("sale_price")),
        Feed("arrests", rows, cal.us_date(F.col("arrest_date")), "num_arrests", where=where["nypd_arrests"]),
        Feed("jobs", rows, cal.us_date(F.col("pre_filing_date")), "jobs_filed", where=where["job_application_filings"]),
    ]


def city_feeds(spark: SparkSession, sf: str) -> list[Feed]:
    """The six feeds that have a plain date column."""
    return [order_feeds(spark, sf)[0], *line_feeds(spark, sf)]


def dated_feeds(spark: SparkSession, sf: str) -> list[Feed]:
    """The two feeds whose dates are text."""
    return order_feeds(spark, sf)[1:]


def all_feeds(spark: SparkSession, sf: str) -> list[Feed]:
    rides = feed(spark, sf, "citibike_daily")
    return [
        *order_feeds(spark, sf),
        *line_feeds(spark, sf),
        Feed("rides", rides, F.col("date"), value_as="citibike_rides", measure=F.col("num_rides")),
    ]


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """One row per sale day: (event_date, 11 measures)."""
    days = aligned_panel(all_feeds(spark, sf), lambda d: d.cast("date"), "event_date", "sales")
    return days.select("event_date", *MEASURES)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for output."""
    doubles = [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({n: F.round(F.col(n), digits) for n in doubles})


define("us_arrests", "SELECT CAST(try_strptime(arrest_date, '%m/%d/%Y') AS DATE) AS date FROM nypd_arrests")
define("us_jobs", "SELECT CAST(try_strptime(pre_filing_date, '%m/%d/%Y') AS DATE) AS date FROM job_application_filings")
define(
    "panel",
    """
    SELECT s.event_date, s.avg_price, s.total_sales, c.n AS complaints, b.n AS new_businesses, e.n AS evictions,
           r.n AS new_restaurants, h.avg_health_inspection, h.total_inspections, a.n AS num_arrests,
           j.n AS jobs_filed, cb.num_rides AS citibike_rides
    FROM (SELECT sale_date AS event_date, COUNT(*) AS total_sales, AVG(sale_price) AS avg_price FROM sales GROUP BY 1) s
    LEFT JOIN (SELECT date, COUNT(*) AS n FROM complaints GROUP BY 1) c ON s.event_date = c.date
    LEFT JOIN (SELECT date, COUNT(*) AS n FROM businesses GROUP BY 1) b ON s.event_date = b.date
    LEFT JOIN (SELECT date, COUNT(*) AS n FROM evictions GROUP BY 1) e ON s.event_date = e.date
    LEFT JOIN (SELECT date, COUNT(*) AS n FROM restaurants GROUP BY 1) r ON s.event_date = r.date
    LEFT JOIN (SELECT date, AVG(score) AS avg_health_inspection, COUNT(*) AS total_inspections
               FROM health_inspections GROUP BY 1) h ON s.event_date = h.date
    LEFT JOIN (SELECT date, COUNT(*) AS n FROM us_arrests GROUP BY 1) a ON s.event_date = a.date
    LEFT JOIN (SELECT date, COUNT(*) AS n FROM us_jobs GROUP BY 1) j ON s.event_date = j.date
    LEFT JOIN citibike_daily cb ON s.event_date = cb.date
    """,
)
PANEL_OUT = """event_date, ROUND(avg_price, 4) AS avg_price, total_sales, complaints, new_businesses, evictions,
    new_restaurants, ROUND(avg_health_inspection, 4) AS avg_health_inspection, total_inspections, num_arrests,
    jobs_filed, citibike_rides"""


@query("daily_panel", f"SELECT {PANEL_OUT} FROM panel")
def daily_panel(spark, sf):
    return rounded(panel(spark, sf))


@query(
    "weekly_panel",
    """
    SELECT s.yr_week, s.total_sales, ROUND(s.avg_price, 4) AS avg_price, c.n AS complaints, b.n AS new_businesses,
           e.n AS evictions, r.n AS new_restaurants, ROUND(h.avg_health_inspection, 4) AS avg_health_inspection,
           h.total_inspections
    FROM (SELECT strftime(sale_date, '%G-%V') AS yr_week, COUNT(*) AS total_sales, AVG(sale_price) AS avg_price
          FROM sales GROUP BY 1) s
    LEFT JOIN (SELECT strftime(date, '%G-%V') AS k, COUNT(*) AS n FROM complaints GROUP BY 1) c ON s.yr_week = c.k
    LEFT JOIN (SELECT strftime(date, '%G-%V') AS k, COUNT(*) AS n FROM businesses GROUP BY 1) b ON s.yr_week = b.k
    LEFT JOIN (SELECT strftime(date, '%G-%V') AS k, COUNT(*) AS n FROM evictions GROUP BY 1) e ON s.yr_week = e.k
    LEFT JOIN (SELECT strftime(date, '%G-%V') AS k, COUNT(*) AS n FROM restaurants GROUP BY 1) r ON s.yr_week = r.k
    LEFT JOIN (SELECT strftime(date, '%G-%V') AS k, AVG(score) AS avg_health_inspection,
                      COUNT(*) AS total_inspections FROM health_inspections GROUP BY 1) h ON s.yr_week = h.k
    """,
)
def weekly_panel(spark, sf):
    weeks = aligned_panel(city_feeds(spark, sf), cal.iso_week, "yr_week", "sales")
    return rounded(weeks)


# Counted feeds and the oracle's name for each.
COUNTED_FEEDS = {**{n: n for n in LINE_FEEDS}, "arrests": "us_arrests", "jobs": "us_jobs"}


def feed_events(spark: SparkSession, sf: str) -> DataFrame:
    """All dated events of the counted feeds as (feed, date)."""
    return tagged_events([*line_feeds(spark, sf), *dated_feeds(spark, sf)], {})


_EVENTS_SQL = " UNION ALL ".join(f"SELECT '{n}' AS feed, date FROM {source}" for n, source in COUNTED_FEEDS.items())


@query(
    "daily_counts",
    f"SELECT feed, date AS event_date, COUNT(*) AS n FROM ({_EVENTS_SQL}) GROUP BY 1, 2",
)
def daily_counts(spark, sf):
    """COUNT(*) per day for each feed; unreadable dates form their own NULL day."""
    return feed_events(spark, sf).groupBy("feed", F.col("date").alias("event_date")).agg(F.count("*").alias("n"))


@query(
    "daily_sales",
    "SELECT sale_date AS event_date, COUNT(*) AS total_sales, ROUND(AVG(sale_price), 4) AS avg_price "
    "FROM sales GROUP BY 1",
)
def daily_sales(spark, sf):
    sales = feed(spark, sf, "sales")
    return sales.groupBy(F.col("sale_date").alias("event_date")).agg(
        F.count("*").alias("total_sales"), F.round(F.avg("sale_price"), 4).alias("avg_price")
    )


@query(
    "daily_inspections",
    "SELECT date AS event_date, ROUND(AVG(score), 4) AS avg_health_inspection, COUNT(*) AS total_inspections "
    "FROM health_inspections GROUP BY 1",
)
def daily_inspections(spark, sf):
    rows = feed(spark, sf, "health_inspections")
    return rows.groupBy(F.col("date").alias("event_date")).agg(
        F.round(F.avg("score"), 4).alias("avg_health_inspection"), F.count("*").alias("total_inspections")
    )


@query(
    "weekly_counts",
    f"SELECT feed, strftime(date, '%G-%V') AS yr_week, COUNT(*) AS n FROM ({_EVENTS_SQL}) GROUP BY 1, 2",
)
def weekly_counts(spark, sf):
    """COUNT(*) per ISO week for each feed; unreadable dates form a NULL week of their own."""
    rows = feed_events(spark, sf)
    return rows.groupBy("feed", cal.iso_week(F.col("date")).alias("yr_week")).agg(F.count("*").alias("n"))


@query(
    "rows_with_missing",
    f"SELECT {PANEL_OUT} FROM panel WHERE " + " OR ".join(f"{m} IS NULL" for m in CORE_MEASURES),
)
def rows_with_missing(spark, sf):
    return rounded(filters.rows_with_missing(panel(spark, sf), CORE_MEASURES))


@query(
    "null_profile",
    " UNION ALL ".join(
        f"SELECT '{m}' AS column_name, COUNT(*) - COUNT({m}) AS missing, "
        f"ROUND((COUNT(*) - COUNT({m})) / COUNT(*), 6) AS missing_share FROM panel"
        for m in MEASURES
    ),
)
def null_profile(spark, sf):
    return rounded(aggregates.null_profile(panel(spark, sf), MEASURES), 6)


@query(
    "histogram",
    """
    WITH long AS (UNPIVOT (SELECT CAST(COLUMNS(* EXCLUDE event_date) AS DOUBLE) FROM panel)
                  ON COLUMNS(*) INTO NAME feature VALUE v),
         lim AS (SELECT feature, MIN(v) AS lo, MAX(v) AS hi FROM long GROUP BY 1)
    SELECT feature, CAST(LEAST(FLOOR((v - lo) / (hi - lo) * 25) + 1, 25) AS BIGINT) AS bin, COUNT(*) AS n
    FROM long JOIN lim USING (feature) GROUP BY 1, 2
    """,
)
def histogram(spark, sf):
    return aggregates.histogram(panel(spark, sf), MEASURES)


# --- date keys -------------------------------------------------------------------------------


@query(
    "day_key",
    "SELECT sale_id, strftime(sale_date, '%Y-%m-%d') AS day_text, sale_date AS day FROM sales",
)
def day_key(spark, sf):
    text = cal.day_text(F.col("sale_date"))
    return feed(spark, sf, "sales").select("sale_id", text.alias("day_text"), F.to_date(text, "yyyy-MM-dd").alias("day"))


@query("iso_week_key", "SELECT sale_id, strftime(sale_date, '%G-%V') AS yr_week FROM sales")
def iso_week_key(spark, sf):
    return feed(spark, sf, "sales").select("sale_id", cal.iso_week(F.col("sale_date")).alias("yr_week"))


@query(
    "month_keys",
    "SELECT sale_id, CAST(date_trunc('month', sale_date) AS DATE) AS month_start, "
    "strftime(sale_date, '%Y-%m') AS month, CAST(year(sale_date) AS INTEGER) AS year FROM sales",
)
def month_keys(spark, sf):
    d = F.col("sale_date")
    return feed(spark, sf, "sales").select(
        "sale_id", cal.month_start(d).alias("month_start"), cal.month_text(d).alias("month"), F.year(d).alias("year")
    )


@query(
    "month_end",
    "SELECT sale_id, CAST(date_trunc('month', sale_date) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS month_end "
    "FROM sales",
)
def month_end(spark, sf):
    return feed(spark, sf, "sales").select("sale_id", cal.month_end(F.col("sale_date")).alias("month_end"))


@query(
    "parse_us_date",
    "SELECT arrest_date, CAST(try_strptime(arrest_date, '%m/%d/%Y') AS DATE) AS parsed, COUNT(*) AS n "
    "FROM nypd_arrests GROUP BY 1, 2",
)
def parse_us_date(spark, sf):
    rows = feed(spark, sf, "nypd_arrests")
    return rows.groupBy("arrest_date", cal.us_date(F.col("arrest_date")).alias("parsed")).agg(F.count("*").alias("n"))


@query(
    "parse_datetime",
    "SELECT o_orderkey AS sale_id, o_orderdate + to_seconds(CASE WHEN o_orderkey % 4 IN (0, 2) THEN o_orderkey % 86400 "
    "ELSE 0 END) AS parsed FROM orders WHERE o_orderkey % 4 < 3 "
    "UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 4 = 3",
)
def parse_datetime(spark, sf):
    """Four spellings of a time: ISO with time, US date, ISO with a T, and unreadable text."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    moment = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, day)
    text = (
        F.when(key % 4 == 0, F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .when(key % 4 == 1, F.date_format(day, "M/d/yyyy"))
        .when(key % 4 == 2, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.lit("not a date"))
    )
    rows = table(spark, sf, "orders").select(key.alias("sale_id"), text.alias("text"))
    return rows.select("sale_id", cal.any_timestamp(F.col("text")).cast("timestamp_ntz").alias("parsed"))


@query("ordered_output", f"SELECT {PANEL_OUT} FROM panel ORDER BY total_sales DESC, event_date ASC")
def ordered_output(spark, sf):
    return rounded(panel(spark, sf)).orderBy(F.desc_nulls_last("total_sales"), F.asc("event_date"))


@query("limit_preview", f"SELECT {PANEL_OUT} FROM panel ORDER BY event_date LIMIT 5")
def limit_preview(spark, sf):
    return rounded(panel(spark, sf).orderBy("event_date").limit(5))
