"""Numbers, money, names and identifiers as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Borough codes, residential class numbers, tract bins, inspection grades.
BOROUGHS = {1: "Manhattan", 2: "Bronx", 3: "Brooklyn", 4: "Queens", 5: "Staten Island"}
KEPT_CLASSES = [*range(1, 18), 23, 28, *range(42, 50)]
TRACT_STEP = 10000
TRACT_TOP = 300000
GRADE_B_FROM = 14
GRADE_C_ABOVE = 27


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def to_number(text: Column) -> Column:
    """Text to double; unreadable text and the text `nan` give NULL."""
    return nan_to_null(text.try_cast("double"))


def to_whole_number(text: Column) -> Column:
    """Text to bigint, truncating towards zero; unreadable text gives NULL."""
    return to_number(text).cast("bigint")


def tract_bin(tract: Column) -> Column:
    """Bins (0,10000] .. (290000,300000] numbered 1..30; anything outside is NULL."""
    inside = (tract > 0) & (tract <= TRACT_TOP)
    return F.when(inside, F.ceil(tract / TRACT_STEP).cast("int"))


def inspection_grade(score: Column) -> Column:
    return (
        F.when(score < GRADE_B_FROM, "A").when(score <= GRADE_C_ABOVE, "B").when(score.isNotNull(), "C")
    )


def price_per_unit(price: Column, units: Column) -> Column:
    known = units.isNotNull() & (units != 0)
    return F.when(known, price / F.nullif(units, F.lit(0))).otherwise(price.cast("double"))


def price_per_area(price: Column, area: Column) -> Column:
    return F.when(area == 0, F.lit(0.0)).otherwise(price / F.nullif(area, F.lit(0)))


def borough_name(code: Column) -> Column:
    pairs = [F.lit(v) for kv in BOROUGHS.items() for v in kv]
    return F.coalesce(F.create_map(*pairs)[code.try_cast("int")], code.cast("string"))


def class_number(category: Column) -> Column:
    """Digits of the first word of a building class category."""
    digits = F.regexp_replace(F.split_part(category, F.lit(" "), F.lit(1)), "[^0-9]", "")
    return digits.try_cast("int")


def clean_fee(text: Column) -> Column:
    return to_number(F.regexp_replace(text, r"HOA Fee: |monthly|[$, ]", ""))


def cusip8(cusip: Column) -> Column:
    """Identifier without its check digit (the last character)."""
    return F.substring(cusip, F.lit(1), F.length(cusip) - 1)


def name_tokens(name: Column) -> Column:
    return F.filter(F.split(name, r"\s+"), lambda t: t != "")


def first_name(name: Column) -> Column:
    return F.get(name_tokens(name), F.lit(0))


def last_name(name: Column) -> Column:
    """Last word, only when the name has more than one word."""
    tokens = name_tokens(name)
    return F.when(F.size(tokens) > 1, F.element_at(tokens, -1))


def lead_last_name(name: Column) -> Column:
    """Last word of the part after the last dash."""
    after_dash = F.element_at(F.split(name, "-"), -1)
    return F.element_at(F.split(after_dash, " "), -1)


def currency(amount: Column) -> Column:
    """Whole dollars with thousands separators, from the truncated amount."""
    return F.concat(F.lit("$"), F.format_number(amount.cast("bigint"), 0))


def content_id(*parts: Column) -> Column:
    """First 24 hex digits of the SHA-256 of the joined parts."""
    return F.substring(F.sha2(F.concat(*[p.cast("string") for p in parts]), 256), 1, 24)


def address_line(street: Column, city: Column, state: Column) -> Column:
    return F.concat_ws(", ", street, city, state)


def signed_coordinate(text: Column) -> Column:
    """Coordinate text; a leading plus sign is dropped."""
    return F.regexp_replace(text, r"^\+", "").try_cast("double")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def safe_ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))
