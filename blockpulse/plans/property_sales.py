"""Property sales clean-up and the census-tract panels."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockpulse.fixtures import feed, table
from blockpulse.functions import calendar as cal
from blockpulse.functions import values as val
from blockpulse.operators import aggregates, filters, joins
from blockpulse.oracle import define
from blockpulse.operators.panel import tagged_events
from blockpulse.plans.panels import line_feeds, rounded
from blockpulse.plans.registry import query

_KEPT = ", ".join(str(n) for n in val.KEPT_CLASSES)

define(
    "clean_sales",
    f"""
    SELECT *, CASE WHEN total_units IS NULL OR total_units = 0 THEN CAST(sale_price AS DOUBLE)
                   ELSE sale_price / total_units END AS pp_unit,
           CASE WHEN gross_sf = 0 THEN 0.0 ELSE sale_price / gross_sf END AS ppsf
    FROM (SELECT *, TRY_CAST(regexp_replace(split_part(building_class_category, ' ', 1), '[^0-9]', '', 'g') AS INTEGER)
                 AS building_class_num FROM sales WHERE sale_price > 10000 AND sale_price < 7500000)
    WHERE building_class_num IN ({_KEPT})
    """,
)


@query(
    "price_outlier_filter",
    "SELECT sale_id, sale_price FROM sales WHERE sale_price IS NOT NULL AND sale_price > 10000 AND sale_price < 7500000",
)
def price_outlier_filter(spark, sf):
    return filters.price_outlier_filter(feed(spark, sf, "sales"), "sale_price").select("sale_id", "sale_price")


@query(
    "class_filter",
    f"""SELECT sale_id, building_class_category, CAST(substr(building_class_category, 1, 2) AS INTEGER) AS building_class_num
    FROM sales WHERE CAST(substr(building_class_category, 1, 2) AS INTEGER) IN ({_KEPT})""",
)
def class_filter(spark, sf):
    kept = filters.class_filter(feed(spark, sf, "sales"), "building_class_category")
    return kept.select("sale_id", "building_class_category", "building_class_num")


def clean_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Outliers removed, residential classes kept, price metrics added."""
    sales = filters.price_outlier_filter(feed(spark, sf, "sales"), "sale_price")
    kept = filters.class_filter(sales, "building_class_category")
    return filters.with_price_metrics(kept, "sale_price", "total_units", "gross_sf")


@query("price_metrics", "SELECT sale_id, ROUND(pp_unit, 4) AS pp_unit, ROUND(ppsf, 4) AS ppsf FROM clean_sales")
def price_metrics(spark, sf):
    return rounded(clean_sales(spark, sf).select("sale_id", "pp_unit", "ppsf"))


@query("ppu_filter", "SELECT sale_id, ROUND(pp_unit, 4) AS pp_unit FROM clean_sales WHERE pp_unit >= 50000")
def ppu_filter(spark, sf):
    return rounded(filters.ppu_filter(clean_sales(spark, sf)).select("sale_id", "pp_unit"))


_BOROUGH_SQL = "CASE borough " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in val.BOROUGHS.items()) + " END"


@query("borough_name", f"SELECT sale_id, {_BOROUGH_SQL} AS borough, 'NY' AS state FROM sales")
def borough_name(spark, sf):
    return feed(spark, sf, "sales").select(
        "sale_id", val.borough_name(F.col("borough")).alias("borough"), F.lit("NY").alias("state")
    )


@query(
    "sales_etl",
    f"""SELECT sale_id, sale_price, {_BOROUGH_SQL} AS borough, ROUND(pp_unit, 4) AS pp_unit, ROUND(ppsf, 4) AS ppsf,
    sale_date AS date, CAST(year(sale_date) AS INTEGER) AS year FROM clean_sales WHERE pp_unit >= 50000""",
)
def sales_etl(spark, sf):
    """The whole sales clean-up as one narrow, shuffle-free stage."""
    kept = filters.ppu_filter(clean_sales(spark, sf))
    day = F.col("sale_date")
    return rounded(
        kept.select(
            "sale_id", "sale_price", val.borough_name(F.col("borough")).alias("borough"), "pp_unit", "ppsf",
            day.alias("date"), F.year(day).alias("year"),
        )
    )


@query(
    "union_all",
    "SELECT sale_id, sale_date, sale_price, CAST(year(sale_date) AS INTEGER) AS year FROM sales",
)
def union_all(spark, sf):
    """The earlier and the later sales files, concatenated by column name."""
    sales = feed(spark, sf, "sales").select("sale_id", "sale_date", "sale_price")
    early = F.coalesce(F.col("sale_date") < F.lit(date(2000, 1, 1)), F.lit(False))
    parts = [sales.where(early), sales.where(~early)]
    return reduce(DataFrame.unionByName, parts).withColumn("year", F.year("sale_date"))


# --- tract panels ----------------------------------------------------------------------------

TRACT_FEEDS = ["complaints", "businesses", "evictions", "restaurants"]
_BIN_SQL = "CASE WHEN tract > 0 AND tract <= 300000 THEN CAST(CEIL(tract / 10000) AS INTEGER) END"


@query("tract_bin", f"SELECT sale_id, tract, {_BIN_SQL} AS tract_grp FROM sales")
def tract_bin(spark, sf):
    return feed(spark, sf, "sales").select("sale_id", "tract", val.tract_bin(F.col("tract")).alias("tract_grp"))


@query(
    "grade",
    "SELECT date, score, CASE WHEN score < 14 THEN 'A' WHEN score <= 27 THEN 'B' ELSE 'C' END AS grade, COUNT(*) AS n "
    "FROM health_inspections WHERE score IS NOT NULL GROUP BY 1, 2, 3",
)
def grade(spark, sf):
    scored = feed(spark, sf, "health_inspections").dropna(subset=["score"])
    return scored.groupBy("date", "score", val.inspection_grade(F.col("score")).alias("grade")).agg(F.count("*").alias("n"))


@query(
    "drop_nulls",
    "SELECT sale_id, sale_price, total_units, gross_sf FROM sales "
    "WHERE sale_price IS NOT NULL AND total_units IS NOT NULL AND gross_sf IS NOT NULL",
)
def drop_nulls(spark, sf):
    return feed(spark, sf, "sales").select("sale_id", "sale_price", "total_units", "gross_sf").dropna(how="any")


# Explicit (feed, period) pairs of the tract aggregation.
TRACT_AGGREGATIONS = [
    ("businesses", "year"),
    ("evictions", "year"),
    ("restaurants", "year"),
    ("complaints", "month"),
    ("businesses", "month"),
    ("evictions", "month"),
    ("restaurants", "month"),
]


def tract_feed_counts(spark: SparkSession, sf: str, periods: dict[str, list[str]]) -> DataFrame:
    """(feed, freq, period, tract_grp, n) for {feed: periods}, from one scan of the events."""
    feeds = [f for f in line_feeds(spark, sf) if f.name in periods]
    events = tagged_events(feeds, {"tract": F.col("tract")})
    day = F.col("date")
    keys = {"year": F.year(day).cast("string"), "month": cal.month_text(day)}
    entries = [
        F.when(
            F.col("feed").isin([n for n, wanted in periods.items() if p in wanted]),
            F.struct(F.lit(p).alias("freq"), keys[p].alias("period")),
        )
        for p in keys
    ]
    keyed = events.select(
        "feed", "tract", val.tract_bin(F.col("tract")).alias("tract_grp"), F.inline(F.array_compact(F.array(*entries)))
    )
    keyed = keyed.where("tract_grp IS NOT NULL AND period IS NOT NULL")
    return keyed.groupBy("feed", "freq", "period", "tract_grp").agg(F.count("tract").alias("n"))


def monthly_tract_counts(spark: SparkSession, sf: str, feeds: list[str] | None = None) -> DataFrame:
    counts = tract_feed_counts(spark, sf, {name: ["month"] for name in feeds or TRACT_FEEDS})
    return counts.drop("freq").withColumnRenamed("period", "month")


_PERIOD_SQL = {"year": "CAST(year(date) AS VARCHAR)", "month": "strftime(date, '%Y-%m')"}


@query(
    "tract_counts",
    " UNION ALL ".join(
        f"SELECT '{n}' AS feed, '{p}' AS freq, {_PERIOD_SQL[p]} AS period, {_BIN_SQL} AS tract_grp, COUNT(tract) AS n "
        f"FROM {n} WHERE {_BIN_SQL} IS NOT NULL GROUP BY ALL"
        for n, p in TRACT_AGGREGATIONS
    ),
)
def tract_counts(spark, sf):
    """Seven count tables in one job."""
    periods = {name: [p for n, p in TRACT_AGGREGATIONS if n == name] for name in TRACT_FEEDS}
    return tract_feed_counts(spark, sf, periods)


def tract_prices(spark: SparkSession, sf: str) -> DataFrame:
    day = cal.month_text(F.col("sale_date"))
    return aggregates.tract_mean(feed(spark, sf, "sales"), "tract", day, "month", "sale_price", "avg_price")


define(
    "tract_price",
    f"SELECT strftime(sale_date, '%Y-%m') AS month, {_BIN_SQL} AS tract_grp, AVG(sale_price) AS avg_price FROM sales "
    f"WHERE {_BIN_SQL} IS NOT NULL GROUP BY 1, 2",
)
for _name in TRACT_FEEDS:
    define(
        f"tract_{_name}",
        f"SELECT strftime(date, '%Y-%m') AS month, {_BIN_SQL} AS tract_grp, COUNT(tract) AS n FROM {_name} "
        f"WHERE {_BIN_SQL} IS NOT NULL GROUP BY 1, 2",
    )


define("tract_feeds", " UNION ALL ".join(f"SELECT '{n}' AS feed, * FROM tract_{n}" for n in TRACT_FEEDS))


@query("tract_avg_price", "SELECT month, tract_grp, ROUND(avg_price, 4) AS avg_price FROM tract_price")
def tract_avg_price(spark, sf):
    return rounded(tract_prices(spark, sf))


def _tract_join_sql(how: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feed, month, tract_grp, ROUND(avg_price, 4) AS avg_price, n FROM tract_price "
        f"{how} JOIN tract_{n} USING (month, tract_grp)"
        for n in TRACT_FEEDS
    )


@query("tract_panel_right", _tract_join_sql("RIGHT"))
def tract_panel_right(spark, sf):
    """Monthly tract counts of each feed, with the mean sale price where there was a sale."""
    return rounded(joins.by_tract_month(tract_prices(spark, sf), monthly_tract_counts(spark, sf), "right"))


@query("tract_panel_left", _tract_join_sql("LEFT"))
def tract_panel_left(spark, sf):
    """Mean sale price of every month and tract bin, with the count of each feed where there is one."""
    feeds = F.array(*[F.lit(n) for n in TRACT_FEEDS])
    prices = tract_prices(spark, sf).withColumn("feed", F.explode(feeds))
    counts = monthly_tract_counts(spark, sf)
    return rounded(joins.by_tract_month(prices, counts, "left", ["feed", "month", "tract_grp"]))


# --- addresses -------------------------------------------------------------------------------


@query(
    "address_line",
    f"SELECT sale_id, address || ', ' || {_BOROUGH_SQL} || ', NY' AS full_address FROM sales",
)
def address_line(spark, sf):
    line = val.address_line(F.col("address"), val.borough_name(F.col("borough")), F.lit("NY"))
    return feed(spark, sf, "sales").select("sale_id", line.alias("full_address"))


@query(
    "geocode_lookup",
    """
    SELECT s.sale_id, ref.tract AS geo_tract, ref.block AS geo_block
    FROM sales s JOIN (SELECT o_custkey % 300 AS house, 10000 + o_custkey % 250 AS zip,
                              MIN(o_custkey) * 911 % 310000 AS tract, 'B' || CAST(MIN(o_custkey) % 9 AS VARCHAR) AS block
                       FROM orders WHERE o_custkey % 7 <> 0 GROUP BY 1, 2) ref
    ON s.address = CAST(ref.house AS VARCHAR) || ' Main St' AND s.zip_code = CAST(ref.zip AS VARCHAR)
    """,
)
def geocode_lookup(spark, sf):
    """Sales matched to a table of known addresses on normalised street and zip."""
    known = (
        table(spark, sf, "orders")
        .where("o_custkey % 7 <> 0")
        .groupBy((F.col("o_custkey") % 300).alias("house"), (10000 + F.col("o_custkey") % 250).alias("zip_code"))
        .agg(F.min("o_custkey").alias("k"))
        .select(
            F.concat(F.lit("  "), F.col("house").cast("string"), F.lit(" MAIN  st")).alias("address"),
            "zip_code",
            (F.col("k") * 911 % 310000).alias("geo_tract"),
            F.concat(F.lit("B"), (F.col("k") % 9).cast("string")).alias("geo_block"),
        )
    )
    matched = joins.geocode_lookup(
        feed(spark, sf, "sales"), known, ["address", "zip_code"], ["geo_tract", "geo_block"]
    )
    return matched.select("sale_id", "geo_tract", "geo_block")
