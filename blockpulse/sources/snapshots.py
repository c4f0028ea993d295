"""A stored panel that is refreshed year by year, and always read as one finished state.

Each refresh compares what every year's input adds up to with the manifest of the last one, builds the
years that differ into a folder of their own and then writes a new manifest, which says where each year
lies. Readers follow the newest finished manifest, so they see the state before a refresh or after it;
years without new input keep their files. One refresh runs at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockpulse.sources.files import delete, finished_folders, folders

_MANIFEST = "year int, rows long, mark long, revision int, days long"


def _revisions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.removeprefix("rev=")) for name in finished_folders(spark, f"{path}/manifest"))


def manifest(spark: SparkSession, path: str, revision: int | None = None) -> DataFrame:
    """(year, rows, mark, revision, days) of the newest finished state, or of an earlier one; empty before the first."""
    known = _revisions(spark, path)
    wanted = (known[-1] if known else None) if revision is None else revision
    if wanted is None:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/rev={wanted}")


def refresh(marks: DataFrame, build: Callable[[list[int]], DataFrame], day: str, path: str) -> list[int]:
    """Bring the stored panel up to date; returns the years that were built.

    `marks` is (year, rows, mark): how many rows a year's input has and what they hash to. `build` gives the
    panel of some years, one row per `day`. Years that are gone from the input leave the panel.
    """
    spark = marks.sparkSession
    # One row per calendar year.
    before = {r.year: r for r in manifest(spark, path).collect()}
    now = {r.year: r for r in marks.collect()}
    changed = sorted(y for y, r in now.items() if y not in before or (before[y]["rows"], before[y]["mark"]) != (r["rows"], r["mark"]))
    if not changed and set(now) == set(before):
        return []
    revision = max(_revisions(spark, path), default=0) + 1
    days: dict[int, int] = {}
    if changed:
        # A failed earlier attempt at this revision is overwritten.
        target = f"{path}/data/rev={revision}"
        build(changed).withColumn("year", F.year(day)).write.mode("overwrite").partitionBy("year").parquet(target)
        if folders(spark, target):
            days = {r.year: r["count"] for r in spark.read.parquet(target).groupBy("year").count().collect()}
    rows = [
        (y, r["rows"], r["mark"], revision if y in changed else before[y]["revision"], days.get(y, 0) if y in changed else before[y]["days"])
        for y, r in sorted(now.items())
    ]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/rev={revision}")
    return changed


def _used(spark: SparkSession, path: str, revision: int | None = None) -> list[str]:
    entries = manifest(spark, path, revision).where("days > 0").orderBy("year").collect()
    return [f"{path}/data/rev={r.revision}/year={r.year}" for r in entries]


def read(spark: SparkSession, path: str, schema: T.StructType, revision: int | None = None) -> DataFrame:
    """The panel of the newest finished state, or of an earlier one that was not dropped, with the column `year`."""
    used = _used(spark, path, revision)
    with_year = T.StructType([*schema.fields, T.StructField("year", T.IntegerType())])
    if not used:
        return spark.createDataFrame([], with_year)
    return spark.read.schema(with_year).option("basePath", f"{path}/data").parquet(*used).drop("rev")


def drop_old(spark: SparkSession, path: str) -> None:
    """Delete manifests and years that the newest state does not use. Nobody may still read an earlier state."""
    known = _revisions(spark, path)
    used = set(_used(spark, path))
    for revision in known[:-1]:
        for entry in manifest(spark, path, revision).where("days > 0").collect():
            folder = f"{path}/data/rev={entry.revision}/year={entry.year}"
            if folder not in used:
                delete(spark, folder)
    for revision in known[:-1]:
        delete(spark, f"{path}/manifest/rev={revision}")
