"""Date keys and date parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date and timestamp layouts found in the feeds.
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "yyyyMMdd")
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "M/d/yyyy HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "M/d/yyyy",
)
SCRAPE_FORMAT = "dd/MM/yyyy HH:mm:ss"


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def iso_week(day: Column) -> Column:
    """ISO week key such as `1998-W53` without the W: `1998-53`; the year is the ISO week year."""
    year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(year, F.lit("-"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def us_date(text: Column) -> Column:
    """`MM/DD/YYYY` text, padded or not; unreadable text gives NULL."""
    return F.try_to_date(text, "M/d/yyyy")


def any_date(text: Column) -> Column:
    return F.coalesce(*[F.try_to_date(text, f) for f in DATE_FORMATS])


def any_timestamp(text: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in TIMESTAMP_FORMATS])


def scrape_timestamp(text: Column) -> Column:
    """Scrape time is stored day first, so it has to be parsed before it can be ordered."""
    return F.try_to_timestamp(text, F.lit(SCRAPE_FORMAT))


def period_end(day: Column, freq: str) -> Column:
    """Label of the calendar bin a day belongs to: D, W (ends Sunday), M, Q, Y (end labels)."""
    if freq == "D":
        return day.cast("date")
    if freq == "W":
        return F.next_day(F.date_sub(day, 1), "SUN")
    if freq == "M":
        return F.last_day(day)
    if freq == "Q":
        return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))
    if freq == "Y":
        return F.last_day(F.add_months(F.trunc(day, "year"), 11))
    raise ValueError(f"unknown frequency {freq!r}")


def period_spine(first: Column, last: Column, freq: str) -> Column:
    """Every bin label from `first` to `last` (both already labels of `freq`)."""
    if freq == "D":
        return F.sequence(first, last)
    if freq == "W":
        return F.sequence(first, last, F.expr("INTERVAL 7 DAYS"))
    step = {"M": "INTERVAL 1 MONTH", "Q": "INTERVAL 3 MONTHS", "Y": "INTERVAL 12 MONTHS"}[freq]
    starts = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr(step))
    return F.transform(starts, lambda d: F.last_day(d))
