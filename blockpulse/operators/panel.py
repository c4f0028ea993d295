"""Aligning many event feeds on one calendar key.

All feeds are stacked into one narrow frame and reduced in a single aggregation: the map side
collapses each partition to one row per calendar key before the only shuffle, so neither a busy
day nor a busy feed can overload a task, and no join is needed. Feeds that are slices of one
event table share one scan of it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Feed:
    """One feed: its rows, its date column and the panel columns it contributes.

    `where` picks the feed's rows out of a table that several feeds share. `value_as` passes a
    pre-aggregated value through; such a feed must hold one row per key.
    """

    name: str
    rows: DataFrame
    day: Column
    count_as: str | None = None
    mean_as: str | None = None
    value_as: str | None = None
    measure: Column | None = None
    where: Column | None = None


def _shared(feeds: Sequence[Feed]) -> list[list[Feed]]:
    """Feeds grouped by the frame they read."""
    groups: dict[int, list[Feed]] = {}
    for f in feeds:
        groups.setdefault(id(f.rows), []).append(f)
    return list(groups.values())


def _by_day(group: Sequence[Feed]) -> list[list[Feed]]:
    """Feeds of one frame grouped by their date column."""
    days: dict[str, list[Feed]] = {}
    for f in group:
        days.setdefault(str(f.day), []).append(f)
    return list(days.values())


def _hit(f: Feed) -> Column:
    return F.lit(True) if f.where is None else F.coalesce(f.where, F.lit(False))


def _stacked(feeds: Sequence[Feed], key: Callable[[Column], Column], key_name: str) -> DataFrame:
    """(key, one hit flag per feed, one measure per measured feed).

    A frame is read once. A row whose feeds go by different dates becomes one entry per date.
    """
    parts = []
    for group in _shared(feeds):
        entries = []
        for same_day in _by_day(group):
            fields = [key(same_day[0].day).alias(key_name)]
            for f in group:
                hit = _hit(f) if f in same_day else F.lit(False)
                fields.append(hit.alias(f"hit_{f.name}"))
                if f.measure is not None:
                    fields.append(F.when(hit, f.measure.cast("double")).alias(f"value_{f.name}"))
            any_hit = reduce(lambda a, b: a | b, [_hit(f) for f in same_day])
            entries.append((any_hit, fields))
        if len(entries) == 1:
            any_hit, fields = entries[0]
            parts.append(group[0].rows.where(any_hit).select(*fields))
        else:
            found = F.array_compact(F.array(*[F.when(any_hit, F.struct(*fields)) for any_hit, fields in entries]))
            parts.append(group[0].rows.select(F.inline(found)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _rows_of(f: Feed) -> Column:
    return F.count(F.when(F.col(f"hit_{f.name}"), 1))


def _feed_columns(f: Feed) -> list[Column]:
    n, value = _rows_of(f), F.col(f"value_{f.name}")
    out = []
    if f.count_as:
        out.append(F.nullif(n, F.lit(0)).alias(f.count_as))
    if f.mean_as:
        out.append(F.avg(value).alias(f.mean_as))
    if f.value_as:
        duplicate = F.raise_error(F.lit(f"feed {f.name} holds more than one row per key"))
        out.append(F.when(n > 1, duplicate).otherwise(F.max(value).cast("bigint")).alias(f.value_as))
    return out


def aligned_panel(
    feeds: Sequence[Feed],
    key: Callable[[Column], Column],
    key_name: str,
    spine: str,
) -> DataFrame:
    """One row per key present in the `spine` feed; NULL where another feed has no row."""
    columns = [c for f in feeds for c in _feed_columns(f)]
    in_spine = _rows_of(next(f for f in feeds if f.name == spine))
    panel = (
        _stacked(feeds, key, key_name)
        .where(F.col(key_name).isNotNull())
        .groupBy(key_name)
        .agg(*columns, in_spine.alias("spine_rows"))
    )
    return panel.where("spine_rows > 0").drop("spine_rows")


def tagged_events(feeds: Sequence[Feed], columns: dict[str, Column]) -> DataFrame:
    """Every event as (feed, date, columns); a row that belongs to several feeds appears once for each."""
    parts = []
    for group in _shared(feeds):
        tags = [F.when(_hit(f), F.struct(F.lit(f.name).alias("feed"), f.day.cast("date").alias("date"))) for f in group]
        more = [c.alias(n) for n, c in columns.items()]
        parts.append(group[0].rows.select(F.inline(F.array_compact(F.array(*tags))), *more).select("feed", "date", *columns))
    return reduce(DataFrame.unionByName, parts)


def mean_by(panel: DataFrame, key: Column, key_name: str, means: dict[str, str]) -> DataFrame:
    """Average of panel measures per coarser calendar key: {output: measure}."""
    aggs = [F.avg(F.col(source).cast("double")).alias(out) for out, source in means.items()]
    return panel.groupBy(key.alias(key_name)).agg(*aggs)


def input_marks(feeds: Sequence[Feed]) -> DataFrame:
    """(year, rows, mark): how many rows of all feeds fall into each year, and a sum of hashes of what they hold."""
    rows = _stacked(feeds, lambda d: d.cast("date"), "day").where(F.col("day").isNotNull())
    # Sums of 31-bit numbers: they don't overflow, and repeated rows count.
    mark = F.sum(F.pmod(F.xxhash64(*sorted(rows.columns)), F.lit((1 << 31) - 1)))
    return rows.groupBy(F.year("day").alias("year")).agg(F.count("*").alias("rows"), mark.alias("mark"))
