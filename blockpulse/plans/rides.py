"""Bike rides: header generations, number coercion and station lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockpulse.fixtures import feed, table
from blockpulse.functions import values as val
from blockpulse.operators import joins
from blockpulse.operators.aggregates import rename_and_order
from blockpulse.oracle import define
from blockpulse.plans.registry import query
from blockpulse.session import shared_path
from blockpulse.sources import writers
from blockpulse.sources.rides import ERAS, RIDE_COLUMNS, harmonise, read_ride_folder


def _era_headers(era: int) -> dict[str, str]:
    """{harmonised: header} of one generation of files."""
    return {new: old for old, new in ERAS[era].items()}


def ride_files(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The rides as three frames, each under the headers of its own generation."""
    rows = feed(spark, sf, "rides_raw")
    station = F.col("start_station").try_cast("double")
    content = {
        "end_station_id": F.col("end_station"),
        "start_station_id": F.col("start_station"),
        "stop_time": F.col("stop_time"),
        "start_station_name": F.col("start_name"),
        "start_station_latitude": F.lit(40.0) + station / 1000,
        "user_type": F.col("user_kind"),
        "start_time": F.col("start_time"),
        "start_station_longitude": F.lit(-74.0) + station / 1000,
        "end_station_name": F.col("end_name"),
        "end_station_longitude": F.lit(-74.0) + F.col("end_station").cast("double") / 1000,
        "end_station_latitude": F.lit(40.0) + F.col("end_station").cast("double") / 1000,
    }
    files = []
    for era in range(len(ERAS)):
        headers = _era_headers(era)
        columns = [content[new].alias(headers[new]) for new in RIDE_COLUMNS]
        files.append(rows.where(F.col("era") == era).select(*columns, F.col("ride_id").alias("row number")))
    return files


define(
    "rides",
    """
    SELECT ride_id, end_station AS end_station_id, start_station AS start_station_id, stop_time, start_name AS
        start_station_name, 40.0 + TRY_CAST(start_station AS DOUBLE) / 1000 AS start_station_latitude, user_kind AS user_type,
        start_time, -74.0 + TRY_CAST(start_station AS DOUBLE) / 1000 AS start_station_longitude, end_name AS
        end_station_name, -74.0 + CAST(end_station AS DOUBLE) / 1000 AS end_station_longitude,
        40.0 + CAST(end_station AS DOUBLE) / 1000 AS end_station_latitude
    FROM rides_raw
    """,
)
define(
    "numbered_rides",
    """
    SELECT * REPLACE (CAST(FLOOR(TRY_CAST(start_station_id AS DOUBLE)) AS BIGINT) AS start_station_id,
                      CAST(FLOOR(TRY_CAST(end_station_id AS DOUBLE)) AS BIGINT) AS end_station_id)
    FROM rides WHERE TRY_CAST(start_station_id AS DOUBLE) IS NOT NULL AND TRY_CAST(end_station_id AS DOUBLE) IS NOT NULL
    """,
)
_COORDS = ["start_station_latitude", "start_station_longitude", "end_station_latitude", "end_station_longitude"]
_RIDE_OUT = ", ".join(
    f"ROUND({c}, 6) AS {c}" if c in _COORDS
    else f"CAST({c} AS TIMESTAMP) AS {c}" if c.endswith("_time")
    else c
    for c in RIDE_COLUMNS
)


def _shown(rides: DataFrame) -> DataFrame:
    out = rides.withColumns({c: F.round(F.col(c), 6) for c in _COORDS})
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "stop_time")})


@query("harmonize_rides", f"SELECT {_RIDE_OUT} FROM rides")
def harmonize_rides(spark, sf):
    """A folder of CSV files of three header generations, read by its listing."""
    folder = shared_path(spark, "rides")
    for era, rows in enumerate(ride_files(spark, sf)):
        times = {c: F.col(f"`{c}`").cast("string") for c, kind in rows.dtypes if kind.startswith("timestamp")}
        writers.write_csv(rows.withColumns(times), f"{folder}/era-{era}")
    rides, _ = read_ride_folder(spark, folder)
    return _shown(rides)


@query(
    "project_rename",
    "SELECT user_type AS rider, start_station_name AS from_dock, end_station_name AS to_dock FROM rides",
)
def project_rename(spark, sf):
    return rename_and_order(
        harmonise(ride_files(spark, sf)),
        {"user_type": "rider", "start_station_name": "from_dock", "end_station_name": "to_dock"},
    )


def numbered(rides: DataFrame) -> DataFrame:
    """Station ids as whole numbers; rides without two readable ids are dropped."""
    ids = {c: val.to_whole_number(F.col(c)) for c in ("start_station_id", "end_station_id")}
    return rides.withColumns(ids).dropna(subset=list(ids))


@query(
    "to_number_coerce",
    """SELECT ride_id, start_station, CAST(FLOOR(TRY_CAST(start_station AS DOUBLE)) AS BIGINT) AS start_station_id
    FROM rides_raw""",
)
def to_number_coerce(spark, sf):
    rows = feed(spark, sf, "rides_raw")
    return rows.select("ride_id", "start_station", val.to_whole_number(F.col("start_station")).alias("start_station_id"))


@query(
    "rides_geocoded",
    """SELECT end_station_id, start_station_id, CAST(start_time AS TIMESTAMP) AS start_time, user_type, block, tract
    FROM numbered_rides LEFT JOIN stations USING (end_station_id)""",
)
def rides_geocoded(spark, sf):
    rides = numbered(harmonise(ride_files(spark, sf)))
    placed = joins.lookup(rides, feed(spark, sf, "stations"), ["end_station_id"], ["block", "tract"])
    return placed.select(
        "end_station_id",
        "start_station_id",
        F.col("start_time").cast("timestamp_ntz").alias("start_time"),
        "user_type",
        "block",
        "tract",
    )


@query(
    "signed_coord",
    "SELECT s_suppkey AS end_station_id, 40.0 + s_suppkey / 1000 AS lat, -74.0 + s_suppkey / 1000 AS lon FROM supplier",
)
def signed_coord(spark, sf):
    """Coordinates stored as text, the latitude with a leading sign."""
    n = F.col("end_station_id") / 1000
    stations = feed(spark, sf, "stations").select(
        "end_station_id",
        F.concat(F.lit("+"), (F.lit(40.0) + n).cast("string")).alias("lat_text"),
        (F.lit(-74.0) + n).cast("string").alias("lon_text"),
    )
    return stations.select(
        "end_station_id",
        val.signed_coordinate(F.col("lat_text")).alias("lat"),
        val.signed_coordinate(F.col("lon_text")).alias("lon"),
    )


@query(
    "horizontal_concat",
    "SELECT s.end_station_id, block, tract, s_name AS station_name, n_name AS area FROM stations s "
    "JOIN supplier ON s_suppkey = s.end_station_id JOIN nation ON n_nationkey = s_nationkey",
)
def horizontal_concat(spark, sf):
    """Frames about the same stations put side by side on the station key, never by position."""
    names = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("end_station_id"), F.col("s_name").alias("station_name"), "s_nationkey"
    )
    areas = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("area"))
    side = feed(spark, sf, "stations").join(names, "end_station_id").join(areas, "s_nationkey")
    return side.drop("s_nationkey")
