"""Tables of one operator run, kept in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blockpulse.session import shared_path

_RUNS: dict[str, list[str]] = {}


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


class Scratch:
    """Writes tables below a new folder of its own and reads them back.

    A written table cuts the lineage, outlives a lost executor and has a known size. Tables that
    no later step reads are dropped at once; those behind a returned frame stay until `sweep`.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = shared_path(spark, label)
        self._count = 0
        _RUNS.setdefault(spark.sparkContext.applicationId, []).append(self.root)

    def write(self, df: DataFrame, name: str, merged: bool = True) -> DataFrame:
        """`merged`: for narrow tables that come out of a shuffle, one task and file per core; many
        small shuffle partitions would else become as many small files."""
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{name}"
        out = df.coalesce(self.spark.sparkContext.defaultParallelism) if merged else df
        out.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            _delete(self.spark, table._scratch_path)


def sweep(spark: SparkSession) -> None:
    """Delete the folders of all runs of this application. Frames that read them end with it."""
    for root in _RUNS.pop(spark.sparkContext.applicationId, []):
        _delete(spark, root)
