"""Row filters and column rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockpulse.functions.values import KEPT_CLASSES, any_of, class_number, price_per_area, price_per_unit

# Bounds of the sales clean-up.
PRICE_FLOOR = 10000
PRICE_CEILING = 7500000
UNIT_PRICE_FLOOR = 50000
MODEL_PRICE_CEILING = 40000000


def rows_with_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(any_of([F.col(c).isNull() for c in columns]))


def price_outlier_filter(df: DataFrame, price: str) -> DataFrame:
    p = F.col(price)
    return df.where((p > PRICE_FLOOR) & (p < PRICE_CEILING))


def class_filter(df: DataFrame, category: str) -> DataFrame:
    numbered = df.withColumn("building_class_num", class_number(F.col(category)))
    return numbered.where(F.col("building_class_num").isin(KEPT_CLASSES))


def with_price_metrics(df: DataFrame, price: str, units: str, area: str) -> DataFrame:
    p = F.col(price)
    return df.withColumns({
        "pp_unit": price_per_unit(p, F.col(units)),
        "ppsf": price_per_area(p, F.col(area)),
    })


def ppu_filter(df: DataFrame, unit_price: str = "pp_unit") -> DataFrame:
    return df.where(F.col(unit_price) >= UNIT_PRICE_FLOOR)


@dataclass(frozen=True)
class QuietRange:
    """Values of a column inside [first, last] are not trusted; `first` None means no lower end."""

    column: str
    first: date | None
    last: date

    def shifted(self, years: int) -> "QuietRange":
        def move(d: date | None) -> date | None:
            return None if d is None else d.replace(year=d.year + years)

        return QuietRange(self.column, move(self.first), move(self.last))


# Ranges in which a feed did not report normally.
QUIET_RANGES = (
    QuietRange("evictions", date(2019, 11, 1), date(2022, 1, 1)),
    QuietRange("avg_health_inspection", date(2020, 10, 1), date(2021, 8, 1)),
    QuietRange("total_inspections", date(2020, 10, 1), date(2021, 8, 1)),
    QuietRange("new_businesses", date(2020, 10, 1), date(2020, 11, 1)),
    QuietRange("complaints", date(2021, 10, 1), date(2022, 2, 1)),
    QuietRange("citibike_2nd_diff", date(2022, 5, 1), date(2022, 9, 1)),
    QuietRange("citibike_2nd_diff", date(2021, 1, 15), date(2021, 5, 1)),
    QuietRange("num_arrests", date(2020, 1, 1), date(2022, 5, 1)),
    QuietRange("new_restaurants", None, date(2020, 10, 31)),
)


def nullify_ranges(df: DataFrame, day: str, rules: Iterable[QuietRange] = QUIET_RANGES) -> DataFrame:
    """NULL out each rule's column inside its range; rules for absent columns are skipped."""
    quiet: dict[str, Column] = {}
    for r in rules:
        if r.column not in df.columns:
            continue
        hit = F.col(day) <= F.lit(r.last)
        if r.first is not None:
            hit = hit & (F.col(day) >= F.lit(r.first))
        quiet[r.column] = hit if r.column not in quiet else (quiet[r.column] | hit)
    return df.withColumns({c: F.when(~F.coalesce(hit, F.lit(False)), F.col(c)) for c, hit in quiet.items()})


def date_range(df: DataFrame, day: str, first: date, last: date) -> DataFrame:
    return df.where(F.col(day).between(F.lit(first), F.lit(last)))


def lead_filters(df: DataFrame, email: str, age: str, max_age: int = 365) -> DataFrame:
    reachable = F.coalesce(F.col(email).contains("@"), F.lit(False))
    return df.where(reachable & (F.col(age) < max_age))


def not_team(df: DataFrame, name: str) -> DataFrame:
    """Drop team accounts; rows without a name go as well."""
    return df.where(~F.col(name).contains("Team"))


# Last trusted day of two features before a causality test (exclusive).
FEATURE_CUTOFFS = {"target_ci": date(2021, 7, 1), "target_ev": date(2020, 2, 1)}


def cutoff_by_feature(
    df: DataFrame, feature: str, ts: str, cutoffs: Mapping[str, date] = FEATURE_CUTOFFS
) -> DataFrame:
    """Keep rows before the cutoff of their feature; features without a cutoff keep all rows."""
    keep = F.lit(True)
    for name, day in cutoffs.items():
        keep = keep & ((F.col(feature) != name) | (F.col(ts) < F.lit(day)))
    return df.where(keep)


def max_value_filter(df: DataFrame, column: str, ceiling: float = MODEL_PRICE_CEILING) -> DataFrame:
    return df.where(F.col(column) < ceiling)


def drop_columns_like(df: DataFrame, pattern: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if pattern in c])
