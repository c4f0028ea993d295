"""Positions over a whole ordered frame without pulling it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockpulse.session import shared_path
from blockpulse.sources.writers import stored


def sorted_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, num, txt, code): rank 0..n-1 of every distinct value per column, sorted.

    Values are range partitioned, numbered inside each partition, and moved by the count of the
    partitions before it. The ranged frame is written with its partition numbers, so that both passes
    see one layout.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), *_sort_key(df, c)) for c in columns])
    distinct = df.select(F.inline(entries)).where("num IS NOT NULL OR txt IS NOT NULL").distinct()
    order = ["column_name", "num", "txt"]
    numbered = distinct.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged = stored(numbered, shared_path(df.sparkSession, "ranged"))
    sizes = ranged.groupBy("column_name", "_part").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("column_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("column_name", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("column_name", "_part").orderBy("num", "txt")
    numbered = ranged.withColumn("_row", F.row_number().over(inside)).join(offsets, ["column_name", "_part"])
    return numbered.select(*order, (F.col("_offset") + F.col("_row") - 1).cast("bigint").alias("code"))


def _sort_key(df: DataFrame, column: str) -> list[Column]:
    """A value as (number, text): numbers and booleans sort as numbers, text as text."""
    is_text = dict(df.dtypes)[column] == "string"
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    if is_text:
        text = F.col(column)
    else:
        number = F.col(column).cast("int").cast("double") if dict(df.dtypes)[column] == "boolean" else F.col(column).cast("double")
    return [number.alias("num"), text.alias("txt")]


def label_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each listed column by the rank of its value; NULL stays NULL.

    The codes are written once to the shared folder, so every lookup knows their size: Spark
    broadcasts a small vocabulary and shuffles a large one.
    """
    spark = df.sparkSession
    path = shared_path(spark, "codes")
    sorted_codes(df, columns).write.partitionBy("column_name").parquet(path)
    kinds = dict(df.dtypes)
    out = df
    for c in columns:
        value = "txt" if kinds[c] == "string" else "num"
        number, text = _sort_key(df, c)
        codes = spark.read.schema("num double, txt string, code bigint").parquet(f"{path}/column_name={c}")
        mine = codes.select(F.col(value).alias("_v"), F.col("code").alias("_code"))
        keyed = out.withColumn("_v", text if value == "txt" else number)
        out = keyed.join(mine, "_v", "left").drop("_v").withColumn(c, F.col("_code")).drop("_code")
    return out.select(*df.columns)
