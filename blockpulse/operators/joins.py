"""Lookups and mappings.

No join here carries a broadcast hint: Spark broadcasts a side on its own when its measured
size is below the threshold, and otherwise shuffles with adaptive skew splitting. A reference
side that had to be aggregated first is written once, for two reasons: the size of the files
decides about the broadcast, and a side that comes straight from a shuffle of its own is what
the skew splitting needs to cut a hot key of the other side into several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockpulse.functions.values import cusip8
from blockpulse.operators.windows import newest_per_key
from blockpulse.session import shared_path
from blockpulse.sources.writers import stored


def unique_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Reference side of a many-to-one join; a repeated key fails the query."""
    repeated = F.raise_error(F.concat(F.lit("repeated join key: "), F.to_json(F.struct(*keys))))
    checked = [
        F.when(F.count("*") > 1, repeated).otherwise(F.any_value(c)).alias(c) for c in columns
    ]
    return df.groupBy(*keys).agg(*checked)


def reference(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Unique reference rows, written to the shared folder."""
    return stored(unique_by(df, keys, columns), shared_path(df.sparkSession, "reference"))


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join that can never change the number of left rows."""
    return left.join(reference(right, keys, columns), list(keys), "left")


def normalised(text: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(text, r"\s+", " ")))


def geocode_lookup(
    rows: DataFrame, known: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Match addresses to a reference table on normalised parts; unmatched rows are left out."""
    parts = {f"_k_{k}": normalised(F.col(k).cast("string")) for k in keys}
    ref = known.select(*[c.alias(n) for n, c in parts.items()], *columns)
    matched = reference(ref, list(parts), columns)
    return rows.withColumns(parts).join(matched, list(parts)).drop(*parts)


def newest_security(secd: DataFrame, tickers: Sequence[str] | None = None) -> DataFrame:
    """Latest row per ticker; ties go to the largest security key, then identifier."""
    rows = secd if tickers is None else secd.where(F.col("tic").isin(list(tickers)))
    return newest_per_key(rows, "tic", [F.col("datadate"), F.col("gvkey"), F.col("cusip")])


def security_map(changes: DataFrame, newest: DataFrame) -> DataFrame:
    """Market identifiers of each security; several per security are all kept."""
    named = newest.select(
        cusip8(F.col("cusip")).alias("cusip"),
        F.col("cusip").alias("cusip_tm"),
        "conm",
        "gvkey",
        F.col("tic").alias("ticker"),
    )
    return changes.join(named, "cusip")


def semi_filter(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return rows.join(keys.select(key), key, "left_semi")


def security_daily(market: DataFrame, mapping: DataFrame, first: date, last: date) -> DataFrame:
    """Market rows of mapped securities inside a date range.

    Every kept market row has a mapping, so the join is written as an inner join and the date
    range sits on the scan.
    """
    in_range = market.where(F.col("marketdate").between(F.lit(first), F.lit(last)))
    return in_range.join(mapping, "infocode")


def by_tract_month(
    prices: DataFrame, counts: DataFrame, how: str, keys: Sequence[str] = ("month", "tract_grp")
) -> DataFrame:
    return prices.join(counts, list(keys), how)
