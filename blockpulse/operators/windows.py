"""Lag, rolling and ranking operators over calendar panels.

The frames these run on are aggregated panels with one row per day, week or month, so a window
without a partition key handles at most a few hundred rows per year whatever the feeds hold.
Operators on many series take a partition key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from blockpulse.functions.values import safe_ratio

SIX_ROWS = 5  # preceding rows of the six-row moving average


def in_order(order: str, partition: Sequence[str] = ()) -> WindowSpec:
    spec = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return spec.orderBy(order)


def moving_average(x: Column, over: WindowSpec, preceding: int = SIX_ROWS) -> Column:
    return F.avg(x).over(over.rowsBetween(-preceding, 0))


def rate_of_change(x: Column, over: WindowSpec) -> Column:
    previous = F.lag(x).over(over)
    return safe_ratio(x - previous, previous)


def trend_flag(x: Column, average: Column) -> Column:
    return F.when(x > average, "increasing").otherwise("decreasing")


def lag_difference(x: Column, over: WindowSpec, rows: int) -> Column:
    return x - F.lag(x, rows).over(over)


def top_ranked(df: DataFrame, partition: str, by: str, n: int, rank_name: str = "rank") -> DataFrame:
    """Rows whose RANK by descending `by` is at most n; NULL ranks first, ties share a rank."""
    spec = Window.partitionBy(partition).orderBy(F.desc_nulls_first(by))
    ranked = df.withColumn(rank_name, F.rank().over(spec).cast("bigint"))
    return ranked.where(F.col(rank_name) <= n)


def newest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the largest `order` tuple per key.

    `max_by` combines on the map side, so a key holding a large share of all rows reaches its
    reducer as one candidate per partition.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(f"`{c}`") for c in rest])
    rank_by = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = df.groupBy(*keys).agg(F.max_by(packed, rank_by).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def supervised_windows(df: DataFrame, order: str, features: Sequence[str], target: str, look_back: int) -> DataFrame:
    """Rows (x, y): x holds the features of the `look_back` rows before the one that gives y."""
    over = in_order(order)
    history = [
        F.array(*[F.lag(F.col(f), k).over(over) for k in range(look_back, 0, -1)]).alias(f"{f}_past")
        for f in features
    ]
    position = F.row_number().over(over)
    framed = df.select(order, *history, F.col(target).alias("y"), position.alias("_pos"))
    return framed.where(F.col("_pos") > look_back).drop("_pos")


def with_global_stats(df: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    """Whole-frame aggregates next to every row, as fields of a struct `stats`.

    They are computed once by a scalar subquery and then used as a constant: no join, and no
    window over the whole frame.
    """
    packed = df.agg(F.struct(*[c.alias(name) for name, c in aggs.items()]).alias("s")).scalar()
    return df.withColumn("stats", packed)
