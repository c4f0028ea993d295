"""Round trips through files and tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import replace
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockpulse.fixtures import feed, line_events, order_events, table
from blockpulse.functions import calendar as cal
from blockpulse.operators.panel import aligned_panel, input_marks
from blockpulse.oracle import define
from blockpulse.plans.panels import MEASURES, PANEL_OUT, all_feeds, panel, rounded
from blockpulse.plans.registry import query
from blockpulse.session import shared_path
from blockpulse.sources import readers, snapshots, writers

CSV_SCHEMAS = {"complaints": "date date, tract double", "restaurants": "date date, tract double"}


@query(
    "read_sources",
    """
    SELECT 'sales' AS source, tract, COUNT(*) AS n, MIN(sale_date) AS first_day, MAX(sale_date) AS last_day
    FROM sales GROUP BY 2
    UNION ALL SELECT 'complaints', tract, COUNT(*), MIN(date), MAX(date) FROM complaints GROUP BY 2
    UNION ALL SELECT 'restaurants', tract, COUNT(*), MIN(date), MAX(date) FROM restaurants GROUP BY 2
    """.replace(" tract,", " CAST(tract AS DOUBLE) AS tract,"),
)
def read_sources(spark, sf):
    """A catalogue of CSV and Parquet files; what was read is counted per source and tract."""
    base = shared_path(spark, "catalogue")
    for name in CSV_SCHEMAS:
        writers.write_csv(feed(spark, sf, name), f"{base}/{name}.csv")
    writers.write_replace({"sales": feed(spark, sf, "sales").select("sale_date", "tract")}, base)
    paths = {"sales": f"{base}/sales.parquet", **{n: f"{base}/{n}.csv" for n in CSV_SCHEMAS}}
    frames = readers.read_catalogue(spark, paths, CSV_SCHEMAS)
    frames["sales"] = frames["sales"].withColumnRenamed("sale_date", "date")
    counted = [
        df.groupBy(F.lit(n).alias("source"), F.col("tract").cast("double").alias("tract")).agg(
            F.count("*").alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
        )
        for n, df in frames.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def sheet_lines(sales: DataFrame) -> DataFrame:
    """Sales as comma-separated lines in the positional layout."""
    text = {
        "BOROUGH": F.when(F.col("sale_id") % 31 != 0, F.col("borough")),
        "BUILDING_CLASS_CATEGORY": F.col("building_class_category"),
        "ADDRESS": F.col("address"),
        "ZIP_CODE": F.col("zip_code"),
        "TOTAL_UNITS": F.col("total_units"),
        "GROSS_SF": F.col("gross_sf"),
        "SALE_PRICE": F.col("sale_price"),
        "SALE_DATE": F.when(F.col("sale_id") % 29 != 0, cal.day_text(F.col("sale_date"))),
        "LOT": F.col("sale_id"),
    }
    cells = [F.coalesce(text[c].cast("string"), F.lit("")) if c in text else F.lit("") for c in readers.SHEET_COLUMNS]
    return sales.select(F.concat_ws(",", *cells).alias("value"))


_TITLES = 10
define(
    "sheet_rows",
    """SELECT CASE WHEN sale_id % 31 <> 0 THEN CAST(borough AS INTEGER) END AS borough, building_class_category, CAST(sale_id AS VARCHAR) AS lot,
    address, zip_code, total_units, gross_sf, sale_price, CASE WHEN sale_id % 29 <> 0 THEN sale_date END AS sale_date FROM sales""",
)


def _sheet(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Sheets with ten title lines above the data and some blank boroughs and dates, read again."""
    path = shared_path(spark, "sheet")
    sales = feed(spark, sf, "sales")
    titles = spark.range(_TITLES).select(F.concat(F.lit("Rolling sales, title line "), F.col("id").cast("string")).alias("value"))
    titles.unionByName(sheet_lines(sales)).write.mode("overwrite").text(path)
    return readers.read_positional(spark, path)


@query("read_positional", "SELECT * FROM sheet_rows")
def read_positional(spark, sf):
    """Sheets without a header; data lines with a blank borough or date stay."""
    sheet, _ = _sheet(spark, sf)
    wanted = {
        "BOROUGH": "borough", "BUILDING_CLASS_CATEGORY": "building_class_category", "LOT": "lot", "ADDRESS": "address",
        "ZIP_CODE": "zip_code", "TOTAL_UNITS": "total_units", "GROSS_SF": "gross_sf", "SALE_PRICE": "sale_price",
        "SALE_DATE": "sale_date",
    }
    return sheet.select(*[F.col(c).alias(n) for c, n in wanted.items()])


@query(
    "read_positional_rejects",
    f"""SELECT 'Rolling sales, title line ' || i AS line FROM range(0, {_TITLES}) r(i)
    UNION ALL SELECT CAST(COUNT(*) AS VARCHAR) || ' data lines' FROM sheet_rows""",
)
def read_positional_rejects(spark, sf):
    """The lines that are no data, and how many lines are."""
    sheet, rejects = _sheet(spark, sf)
    kept = sheet.agg(F.concat(F.count("*").cast("string"), F.lit(" data lines")).alias("line"))
    return rejects.select("line").unionByName(kept)


_FILES_SQL = """SELECT 'JC-' || strftime(o_orderdate, '%Y%m') || CASE WHEN month(o_orderdate) % 4 = 0 THEN '.csv' ELSE '.csv.zip' END
    AS path, COUNT(*) AS length FROM orders GROUP BY 1"""


@query(
    "list_inputs",
    f"""SELECT path, length FROM ({_FILES_SQL}) WHERE path LIKE '%.csv.zip'
    QUALIFY ROW_NUMBER() OVER (ORDER BY path DESC) > 14""",
)
def list_inputs(spark, sf):
    """Selection from the listing of a real folder: an input per order month, as long as the month has orders.

    Executors write an input as a folder of parts, a byte (an empty line) per order; its length is theirs together.
    """
    day = F.col("o_orderdate")
    ending = F.when(F.month(day) % 4 == 0, ".csv").otherwise(".csv.zip")
    name = F.concat(F.lit("JC-"), F.date_format(day, "yyyyMM"), ending)
    folder = shared_path(spark, "inputs")
    table(spark, sf, "orders").select(F.lit("").alias("line"), name.alias("input")).write.partitionBy("input").text(folder)
    of_part = F.regexp_extract("path", "/input=([^/]+)/[^/]+$", 1)
    listing = readers.list_files(spark, folder).groupBy(of_part.alias("path")).agg(F.sum("length").alias("length"))
    return readers.select_inputs(listing)


EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def event_archives(events: DataFrame) -> DataFrame:
    """(path, content): one zip per Arrow batch, headers alternating, and one damaged archive per batch."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for i, batch in enumerate(batches):
            name = f"JC-{int(batch['event_id'].min())}"
            table_ = batch.rename(columns={"event_id": "Event ID"} if i % 2 else {"event_id": "id"})
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"{name}.csv", table_.to_csv(index=False))
                archive.writestr("readme.txt", "not a table")
            rows = [(f"{name}.csv.zip", buffer.getvalue()), (f"{name}-damaged.csv.zip", b"PK but not an archive")]
            yield pd.DataFrame(rows, columns=["path", "content"])

    return events.select(*EVENT_COLUMNS).mapInPandas(pack, "path string, content binary")


@query("read_zip_csv", "SELECT event_id, user_id, event_type, value FROM events")
def read_zip_csv(spark, sf):
    """Events packed into zip archives, expanded and parsed again; damaged archives are set aside.

    Spark writes no zip files, so the archives stay in a table; `read_zip_folder` reads them from files.
    """
    archives = writers.stored(event_archives(table(spark, sf, "events")), shared_path(spark, "archives"))
    rows = readers.read_zip_csv(archives, EVENT_COLUMNS, {"id": "event_id", "Event ID": "event_id"})
    kinds = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double"}
    return rows.where("error IS NULL").select(*[F.col(c).cast(kinds[c]).alias(c) for c in EVENT_COLUMNS])


@query("read_table", "SELECT date AS day, num_rides FROM citibike_daily")
def read_table(spark, sf):
    """The daily rides stored as a table and read back by name."""
    path = shared_path(spark, "table")
    name = "rides_" + path.rsplit("-", 1)[-1]  # no table of the user's is replaced
    writers.write_table(feed(spark, sf, "citibike_daily"), name, path)
    rows = readers.read_table(spark, name).select(F.col("date").alias("day"), "num_rides")
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay for the plan
    return rows


@query(
    "write_replace",
    "SELECT 'stations' AS name, end_station_id AS id FROM stations UNION ALL SELECT 'ds2cusipchg', infocode FROM ds2cusipchg",
)
def write_replace(spark, sf):
    """Two datasets written twice below one folder; the second write replaces the first."""
    base = shared_path(spark, "replace")
    stations, codes = feed(spark, sf, "stations"), feed(spark, sf, "ds2cusipchg")
    writers.write_replace({"stations": stations.unionByName(stations), "ds2cusipchg": codes}, base)
    paths = writers.write_replace({"stations": stations, "ds2cusipchg": codes}, base)
    frames = readers.read_catalogue(spark, paths)
    a = frames["stations"].select(F.lit("stations").alias("name"), F.col("end_station_id").alias("id"))
    b = frames["ds2cusipchg"].select(F.lit("ds2cusipchg").alias("name"), F.col("infocode").alias("id"))
    return a.unionByName(b)


@query("write_csv", "SELECT sale_id, sale_date, sale_price, address FROM sales")
def write_csv(spark, sf):
    """An export in two parts, the second appended, read back with a schema."""
    path = shared_path(spark, "export")
    sales = feed(spark, sf, "sales").select("sale_id", "sale_date", "sale_price", "address")
    cut = F.lit("2000-01-01").cast("date")
    writers.write_csv(sales.where(F.col("sale_date") < cut), path)
    writers.write_csv(sales.where(F.col("sale_date") >= cut), path, append=True)
    schema = "sale_id bigint, sale_date date, sale_price bigint, address string"
    return spark.read.schema(schema).option("header", True).csv(path)


@query("panel_mv", f"SELECT {PANEL_OUT} FROM panel WHERE event_date >= DATE '1997-01-01'")
def panel_mv(spark, sf):
    """The panel stored by year; the date filter reads only the years it needs."""
    path = shared_path(spark, "panel")
    writers.store_panel(panel(spark, sf), path, "event_date")
    stored = spark.read.parquet(path).where("year >= 1997 AND event_date >= DATE '1997-01-01'")
    return rounded(stored.drop("year"))


#: The first load holds what is dated before this day, the second load the rest too.
SECOND_LOAD = "2000-07-01"


@query("panel_refresh", f"SELECT {PANEL_OUT} FROM panel")
def panel_refresh(spark, sf):
    """The stored panel after a second load: only the years with new rows are built again."""
    path, days = shared_path(spark, "panel-state"), F.lit(SECOND_LOAD).cast("date")
    for first in (True, False):
        refresh_panel(spark, sf, path, days if first else None)
    return rounded(snapshots.read(spark, path, panel(spark, sf).schema).drop("year"))


def refresh_panel(spark, sf, path, before=None):
    """Refresh the stored panel from the feeds' rows dated `before` a day, or from all; the years that were built."""
    feeds = all_feeds(spark, sf)
    if before is not None:
        feeds = [replace(f, where=(F.lit(True) if f.where is None else f.where) & (f.day.cast("date") < before)) for f in feeds]
    whole = aligned_panel(feeds, lambda d: d.cast("date"), "event_date", "sales").select("event_date", *MEASURES)
    return snapshots.refresh(input_marks(feeds), lambda years: whole.where(F.year("event_date").isin(years)), "event_date", path)


AUDITED = ["sales", "complaints", "businesses", "evictions", "restaurants", "health_inspections", "nypd_arrests", "job_application_filings"]
DATE_COLUMNS = ["sale_date", "date", "arrest_date", "pre_filing_date"]


_TEXT_DATES = {"nypd_arrests": "arrest_date", "job_application_filings": "pre_filing_date"}


@query(
    "schema_audit",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{c}' AS column_name, "
        f"MAX(CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof({c})) END) AS data_type, COUNT({c}) AS filled FROM {n}"
        for n in [*AUDITED, "citibike_daily"]
        for c in [{"sales": "sale_date", **_TEXT_DATES}.get(n, "date")]
    ),
)
def schema_audit(spark, sf):
    """Type and number of values of every date column of the feeds, before any cast; one scan per table."""
    frames = {n: feed(spark, sf, n) for n in [*AUDITED, "citibike_daily"]}
    kinds = {n: next((c, k) for c, k in df.dtypes if c in DATE_COLUMNS) for n, df in frames.items()}
    lines, line_where = line_events(spark, sf)
    orders, order_where = order_events(spark, sf)
    line_counts = {n: F.count(F.when(where, F.col("date"))) for n, where in line_where.items() if n in kinds}
    line_counts["citibike_daily"] = F.count_distinct("date")
    order_counts = {"sales": F.count("sale_date")} | {n: F.count(F.when(where, F.col(kinds[n][0]))) for n, where in order_where.items()}
    parts = []
    for rows, counts in ((lines, line_counts), (orders, order_counts)):
        one = rows.agg(*[c.alias(n) for n, c in counts.items()])
        entries = [
            F.struct(F.lit(n).alias("table_name"), F.lit(kinds[n][0]).alias("column_name"), F.lit(kinds[n][1]).alias("data_type"), F.col(n).alias("filled"))
            for n in counts
        ]
        parts.append(one.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, parts)


def _cast_sql(name: str) -> str:
    column = {"sales": "sale_date", **_TEXT_DATES}.get(name, "date")
    text = name in _TEXT_DATES
    day = f"CAST(try_strptime({column}, '%m/%d/%Y') AS DATE)" if text else column
    return f"SELECT '{name}' AS table_name, {day} AS day, COUNT(*) AS n FROM {name} GROUP BY ALL"


@query("cast_dates", " UNION ALL ".join(_cast_sql(n) for n in AUDITED))
def cast_dates(spark, sf):
    """Rows per day of every feed after its date column was cast; one scan per table."""
    lines, line_where = line_events(spark, sf)
    orders, order_where = order_events(spark, sf)
    cast = readers.cast_dates({"lines": lines, "orders": orders}, DATE_COLUMNS)
    tags = {
        "lines": [(n, where, "date") for n, where in line_where.items() if n in AUDITED],
        "orders": [("sales", F.lit(True), "sale_date"), *[(n, where, _TEXT_DATES[n]) for n, where in order_where.items()]],
    }
    parts = []
    for source, own in tags.items():
        entries = [F.when(where, F.struct(F.lit(n).alias("table_name"), F.col(c).alias("day"))) for n, where, c in own]
        parts.append(cast[source].select(F.inline(F.array_compact(F.array(*entries)))))
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.groupBy("table_name", "day").agg(F.count("*").alias("n"))
