"""Rows that repeat a key, numbered without sorting a key's rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockpulse.llm.scratch import Scratch


def numbered(rows: DataFrame, key: Sequence[str], scratch: Scratch, order: Sequence[str] = ()) -> DataFrame:
    """`rows` with `repeat`: the number of a row among those of its key, from 0, in the given order.

    Rows are range partitioned by key and order, numbered inside each range, and moved by what their key
    has in earlier ranges; a key of very many rows spreads over many ranges. Only the first key of a range
    can have begun earlier. The ranges are written, so that both passes see the same ones; range
    partitioning reads its input twice, so `rows` should be written too.
    """
    key = list(key)
    ranged = rows.repartitionByRange(*key, *order, F.monotonically_increasing_id()).withColumn("range", F.spark_partition_id())
    ranged = scratch.write(ranged, "ranges", merged=False)
    counts = ranged.groupBy("range", *key).agg(F.count("*").alias("n")).groupBy("range")
    ends = counts.agg(F.min(F.struct(*key)).alias("first"), F.max(F.struct(*key, "n")).alias("last"))
    # Two rows per range: what it asks for and what it holds of a key that may go on.
    last = F.struct(*[F.col(f"last.{c}").alias(c) for c in key])
    asks, holds = F.struct(F.col("first").alias("key"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("asks")), F.struct(last.alias("key"), F.col("last.n").alias("n"), F.lit(False).alias("asks"))
    earlier = Window.partitionBy("key").orderBy("range").rangeBetween(Window.unboundedPreceding, -1)
    begun = ends.select("range", F.inline(F.array(asks, holds))).withColumn("before", F.sum("n").over(earlier))
    moved = scratch.write(begun.where("asks AND before > 0").select("range", F.col("key").alias("first"), "before"), "moved")
    inside = F.row_number().over(Window.partitionBy("range", *key).orderBy(*(order or ["range"])))
    # At most one row per range.
    placed = ranged.withColumn("inside", inside).join(F.broadcast(moved), "range", "left")
    before = F.when(F.struct(*key).eqNullSafe(F.col("first")), F.col("before")).otherwise(0)
    return placed.select(*rows.columns, (F.col("inside") - 1 + before).alias("repeat"))
