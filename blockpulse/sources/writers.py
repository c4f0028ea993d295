"""Writers: replaceable tables, CSV exports, partitioned routes and the stored panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_replace(frames: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    """Write each frame as Parquet below `base`, replacing what is there; returns the paths."""
    paths = {}
    for name, df in frames.items():
        paths[name] = f"{base}/{name}.parquet"
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_csv(df: DataFrame, path: str, append: bool = False, header: bool = True) -> None:
    """CSV export. Every part file carries the header, so an appended part stays readable."""
    df.write.option("header", header).mode("append" if append else "overwrite").csv(path)


def write_json(df: DataFrame, path: str, compression: str = "none", rows_per_file: int = 0) -> None:
    """JSON lines. A compressed file is read by one task, so such files need a bound on their rows (0: none)."""
    df.write.mode("overwrite").option("compression", compression).option("maxRecordsPerFile", rows_per_file).json(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def store_panel(panel: DataFrame, path: str, day: str) -> None:
    """The daily panel as files partitioned by year: a date filter reads only its years."""
    panel.withColumn("year", F.year(day)).write.mode("overwrite").partitionBy("year").parquet(path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a frame once and go on from the files: lineage ends here and sizes are known."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
