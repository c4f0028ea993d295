"""Adapters: the generic test tables seen as sales, city feeds, rides, securities and leads.

An adapter is plain projection text that Spark and the SQL oracle both read, so that both
sides start from the same input; the operators themselves are written separately.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Adapter:
    source: str
    columns: dict[str, str]
    where: str | None = None

    def sql(self) -> str:
        cols = ", ".join(f"{expr} AS {name}" for name, expr in self.columns.items())
        tail = f" WHERE {self.where}" if self.where else ""
        return f"SELECT {cols} FROM {self.source}{tail}"


_LINE_FEED = {"date": "CAST(l_shipdate AS DATE)", "tract": "(l_partkey * 1511) % 310000"}

ADAPTERS: dict[str, Adapter] = {
    "sales": Adapter(
        "orders",
        {
            "sale_id": "o_orderkey",
            "sale_date": "CAST(o_orderdate AS DATE)",
            "sale_price": "CASE WHEN o_orderkey % 101 = 0 THEN NULL "
            "ELSE CAST(FLOOR(o_totalprice * 16) AS BIGINT) - 10000 END",
            "borough": "1 + o_custkey % 5",
            "building_class_category": "LPAD(CAST(1 + o_custkey % 50 AS STRING), 2, '0') || ' CLASS'",
            "total_units": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 4 END",
            "gross_sf": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (o_orderkey % 7) * 500 END",
            "tract": "(o_custkey * 2017) % 310000",
            "address": "CAST(o_custkey % 300 AS STRING) || ' Main St'",
            "zip_code": "CAST(10000 + o_custkey % 250 AS STRING)",
        },
    ),
    "complaints": Adapter("lineitem", _LINE_FEED, "l_returnflag = 'R'"),
    "businesses": Adapter("lineitem", _LINE_FEED, "l_returnflag = 'N' AND l_linestatus = 'O'"),
    "evictions": Adapter("lineitem", _LINE_FEED, "l_returnflag = 'A' AND l_linestatus = 'F'"),
    "restaurants": Adapter("lineitem", _LINE_FEED, "l_linenumber = 1"),
    "health_inspections": Adapter(
        "lineitem",
        {**_LINE_FEED, "score": "CASE WHEN l_quantity <= 48 THEN l_quantity END"},
        "l_returnflag = 'N' AND l_linestatus = 'F'",
    ),
    "ride_days": Adapter("lineitem", {"date": "CAST(l_shipdate AS DATE)", "quantity": "l_quantity"}),
    "rides_raw": Adapter(
        "events",
        {
            "era": "event_id % 3",
            "ride_id": "event_id",
            "start_station": "CASE WHEN event_id % 50 = 0 THEN 'bad' WHEN event_id % 50 = 1 THEN NULL "
            "ELSE CAST(user_id AS STRING) || '.0' END",
            "end_station": "CAST((user_id * 7) % 200 AS STRING)",
            "start_time": "CAST(ts AS TIMESTAMP)",
            "stop_time": "CAST(ts AS TIMESTAMP) + INTERVAL 10 MINUTE",
            "start_name": "'Dock ' || CAST(user_id % 90 AS STRING)",
            "end_name": "'Dock ' || CAST((user_id * 7) % 200 AS STRING)",
            "user_kind": "event_type",
        },
    ),
    "stations": Adapter(
        "supplier",
        {
            "end_station_id": "s_suppkey",
            "block": "'B' || CAST(s_suppkey % 9 AS STRING)",
            "tract": "(s_suppkey * 911) % 310000",
        },
    ),
    "ds2cusipchg": Adapter(
        "part",
        {"infocode": "p_partkey", "cusip": "SUBSTRING(LPAD(CAST(p_partkey AS STRING), 9, '0'), 1, 8)"},
    ),
    "ds2dsf": Adapter(
        "lineitem",
        {
            "infocode": "l_partkey",
            "marketdate": "CAST(l_shipdate AS DATE)",
            "line_id": "l_orderkey * 10 + l_linenumber",
            "close_price": "l_extendedprice",
        },
    ),
    "leads": Adapter(
        "orders",
        {
            "lead_id": "o_orderkey",
            "agent_name": "CASE WHEN o_custkey % 41 = 40 THEN NULL ELSE 'Agent ' || "
            "CASE WHEN o_custkey % 3 = 0 THEN 'Mid-Jo ' ELSE '' END || CAST(o_custkey % 997 AS STRING) || "
            "CASE WHEN o_custkey % 40 % 9 = 0 THEN ' Team' ELSE '' END END",
            "price": "FLOOR(o_totalprice)",
            "street": "CAST(o_custkey % 300 AS STRING) || ' Main St'",
            "city": "CASE WHEN o_custkey % 2 = 0 THEN 'New York' ELSE 'Albany' END",
            "zipcode": "CAST(10000 + o_custkey % 250 AS STRING)",
            "state": "CASE WHEN o_custkey % 3 = 0 THEN 'NJ' ELSE 'NY' END",
            "agent_email": "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'none' "
            "ELSE 'a' || CAST(o_custkey AS STRING) || '@mail.test' END",
            "agent_phone": "'555-' || LPAD(CAST(o_custkey % 10000 AS STRING), 4, '0')",
            "days_listed": "o_orderkey % 500",
        },
    ),
}

# Day text in month/day/year order; the oracle spells the pattern its own way.
_US_TEXT = {
    "nypd_arrests": ("arrest_date", "o_orderstatus = 'F'", "CASE WHEN o_orderkey % 97 = 0 THEN '13/45/2020' ELSE {d} END"),
    "job_application_filings": ("pre_filing_date", "o_orderpriority = '1-URGENT'", "{d}"),
}
_US_DAY_SPARK = "date_format(o_orderdate, 'MM/dd/yyyy')"
_US_DAY_DUCK = "strftime(o_orderdate, '%m/%d/%Y')"


# Known schemas: nothing has to be read from the files to plan a query.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Feeds that are slices of the line items.
LINE_FEEDS = ["complaints", "businesses", "evictions", "restaurants", "health_inspections"]


def line_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, Column]]:
    """The line items once, as (date, tract, score, ..), and the condition that picks each feed."""
    lines = table(spark, sf_dir, "lineitem")
    score = ADAPTERS["health_inspections"].columns["score"]
    rows = lines.selectExpr(
        *[f"{expr} AS {name}" for name, expr in _LINE_FEED.items()], f"{score} AS score",
        "l_returnflag", "l_linestatus", "l_linenumber",
    )
    return rows, {name: F.expr(ADAPTERS[name].where) for name in LINE_FEEDS}


def order_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, Column]]:
    """The orders once, with the columns of the feeds made of them, and the condition of each feed."""
    sales = ADAPTERS["sales"].columns
    texts = [f"{expr.format(d=_US_DAY_SPARK)} AS {column}" for column, _, expr in _US_TEXT.values()]
    rows = table(spark, sf_dir, "orders").selectExpr(
        f"{sales['sale_date']} AS sale_date", f"{sales['sale_price']} AS sale_price", *texts, "o_orderstatus", "o_orderpriority"
    )
    return rows, {name: F.expr(where) for name, (_, where, _) in _US_TEXT.items()}


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapted feed as a DataFrame."""
    if name in _US_TEXT:
        column, where, expr = _US_TEXT[name]
        rows = table(spark, sf_dir, "orders").where(where)
        return rows.selectExpr(f"{expr.format(d=_US_DAY_SPARK)} AS {column}")
    if name == "citibike_daily":
        days = feed(spark, sf_dir, "ride_days").groupBy("date")
        return days.agg(F.sum("quantity").cast("bigint").alias("num_rides"))
    if name == "secd_newest":
        # One row per part, its newest line: the join gets as many rows as there are parts.
        lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.max("l_shipdate").alias("l_shipdate"))
        parts = table(spark, sf_dir, "part")
        return lines.join(parts, lines.l_partkey == parts.p_partkey).selectExpr(*SECD_COLUMNS)
    if name == "secd":
        lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate")
        parts = table(spark, sf_dir, "part")
        return lines.join(parts, lines.l_partkey == parts.p_partkey).selectExpr(*SECD_COLUMNS)
    adapter = ADAPTERS[name]
    rows = table(spark, sf_dir, adapter.source)
    if adapter.where:
        rows = rows.where(adapter.where)
    return rows.selectExpr(*[f"{expr} AS {alias}" for alias, expr in adapter.columns.items()])


SECD_COLUMNS = [
    "p_partkey AS gvkey",
    "p_brand AS tic",
    "LPAD(CAST(p_partkey AS STRING), 9, '0') AS cusip",
    "p_name AS conm",
    "CAST(l_shipdate AS DATE) AS datadate",
]


def oracle_ctes() -> dict[str, str]:
    """The same adapters as named SQL for the oracle."""
    ctes = {name: adapter.sql() for name, adapter in ADAPTERS.items()}
    for name, (column, where, expr) in _US_TEXT.items():
        ctes[name] = f"SELECT {expr.format(d=_US_DAY_DUCK)} AS {column} FROM orders WHERE {where}"
    ctes["citibike_daily"] = (
        "SELECT date, CAST(SUM(quantity) AS BIGINT) AS num_rides FROM ride_days GROUP BY date"
    )
    ctes["secd"] = "SELECT {} FROM lineitem JOIN part ON l_partkey = p_partkey".format(
        ", ".join(SECD_COLUMNS)
    )
    return ctes
