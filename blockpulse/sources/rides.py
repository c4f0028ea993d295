"""Ride files: three generations of headers brought to one schema."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockpulse.sources.files import first_line, list_paths

# Output columns, in order.
RIDE_COLUMNS = [
    "end_station_id",
    "start_station_id",
    "stop_time",
    "start_station_name",
    "start_station_latitude",
    "user_type",
    "start_time",
    "start_station_longitude",
    "end_station_name",
    "end_station_longitude",
    "end_station_latitude",
]

# Fixed values: {file header: output name}, one map per generation of files.
ERAS: list[dict[str, str]] = [
    {
        "starttime": "start_time",
        "stoptime": "stop_time",
        "start station id": "start_station_id",
        "start station name": "start_station_name",
        "start station latitude": "start_station_latitude",
        "start station longitude": "start_station_longitude",
        "end station id": "end_station_id",
        "end station name": "end_station_name",
        "end station latitude": "end_station_latitude",
        "end station longitude": "end_station_longitude",
        "usertype": "user_type",
    },
    {
        "Start Time": "start_time",
        "Stop Time": "stop_time",
        "Start Station ID": "start_station_id",
        "Start Station Name": "start_station_name",
        "Start Station Latitude": "start_station_latitude",
        "Start Station Longitude": "start_station_longitude",
        "End Station ID": "end_station_id",
        "End Station Name": "end_station_name",
        "End Station Latitude": "end_station_latitude",
        "End Station Longitude": "end_station_longitude",
        "User Type": "user_type",
    },
    {
        "started_at": "start_time",
        "ended_at": "stop_time",
        "start_station_id": "start_station_id",
        "start_station_name": "start_station_name",
        "start_lat": "start_station_latitude",
        "start_lng": "start_station_longitude",
        "end_station_id": "end_station_id",
        "end_station_name": "end_station_name",
        "end_lat": "end_station_latitude",
        "end_lng": "end_station_longitude",
        "member_casual": "user_type",
    },
]
HEADERS: dict[str, str] = {old: new for era in ERAS for old, new in era.items()}


def harmonise(files: Sequence[DataFrame]) -> DataFrame:
    """Rename by the header map, keep ids as text, project the eleven columns, stack."""
    parts = []
    for df in files:
        renamed = df.withColumnsRenamed(HEADERS)
        parts.append(
            renamed.select(
                *[F.col(c).cast("string").alias(c) if c.endswith("_id") else F.col(c) for c in RIDE_COLUMNS]
            )
        )
    return reduce(DataFrame.unionByName, parts)


def read_ride_folder(spark: SparkSession, path: str, suffix: str = ".csv") -> tuple[DataFrame, DataFrame]:
    """(rides, rejects) of a folder of CSV files with mixed headers.

    The driver looks at the first line of each file only; files with equal headers are read together
    under that header, so every row is read once. A file that lacks one of the eleven columns is in
    `rejects` (path, reason).
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    rejected = []
    for file, _ in list_paths(spark, path, suffix):
        line = first_line(spark, file)
        header = tuple(next(csv.reader([line]))) if line else ()
        missing = sorted(set(RIDE_COLUMNS) - {HEADERS.get(c, c) for c in header})
        if missing:
            rejected.append((file, "no " + ", ".join(missing)))
        else:
            by_header.setdefault(header, []).append(file)
    frames = []
    for header, files in by_header.items():
        schema = ", ".join(f"`{c}` STRING" for c in header)
        frames.append(spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", False).csv(files))
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in RIDE_COLUMNS))
    return harmonise(frames) if frames else empty, spark.createDataFrame(rejected, "path string, reason string")
