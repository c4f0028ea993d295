"""Expressions over arrays of structs and embedded JSON. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def field_values(items: Column, field: str) -> Column:
    """Array of one field of an array of structs, NULL entries removed."""
    return F.filter(F.transform(items, lambda x: x[field]), lambda v: v.isNotNull())


def mean_of_field(items: Column, field: str, digits: int | None = None) -> Column:
    """Mean of the non-null values of a field; NULL for a NULL array or no values.

    Sum and count are kept in one accumulator, so the array is walked once.
    """
    start = F.named_struct(F.lit("total"), F.lit(0.0), F.lit("n"), F.lit(0))

    def add(acc: Column, x: Column) -> Column:
        value = x[field].cast("double")
        return F.when(
            value.isNotNull(), F.named_struct(F.lit("total"), acc["total"] + value, F.lit("n"), acc["n"] + 1)
        ).otherwise(acc)

    mean = F.aggregate(items, start, add, lambda acc: F.when(acc["n"] > 0, acc["total"] / acc["n"]))
    return mean if digits is None else F.round(mean, digits)


def count_where_field(items: Column, field: str, wanted: str) -> Column:
    return F.when(items.isNotNull(), F.size(F.filter(items, lambda x: x[field] == wanted)))


def count_of_field(items: Column, field: str) -> Column:
    return F.when(items.isNotNull(), F.size(field_values(items, field)))


def first_field(items: Column, field: str) -> Column:
    """Field of the first element; NULL for a NULL or empty array."""
    return F.get(items, F.lit(0))[field]


def pluck(items: Column, field: str) -> Column:
    return F.transform(items, lambda x: x[field])


def drop_fields(items: Column, *fields: str) -> Column:
    return F.transform(items, lambda x: x.dropFields(*fields))


# A text in double quotes, and the same without the code of a character; a text in single quotes without
# a bare double quote; what a text that is all literals consists of. Groups repeat without going back, so matching is linear.
_DOUBLE = r'"(?:[^"\\]++|\\.)*+"'
_UNCODED = r"""(?:[^"\\]++|\\(?!x[0-9a-fA-F]{2}).)*+"""
_UNQUOTED = r"""(?:[^'"\\]++|\\.)*+"""
_WHOLE = rf"""(?s)\A(?:[^'"]++|'(?:[^'\\]++|\\.)*+'|{_DOUBLE})*+\z"""
# Where a match ends inside a text, the next one begins there (\G), and any other at the start (\A).
_BARE_QUOTE = (
    rf"""(?s)\G((?:\A(?:[^'"]++|{_DOUBLE}|'{_UNQUOTED}')*+'{_UNQUOTED}|"""
    rf"""(?!\A){_UNQUOTED}(?:'(?:[^'"]++|{_DOUBLE}|'{_UNQUOTED}')*+'{_UNQUOTED})?+))\""""
)
_CODE = (
    rf"""(?s)\G((?:\A(?:[^"]++|"{_UNCODED}")*+"{_UNCODED}|"""
    rf"""(?!\A){_UNCODED}(?:"(?:[^"]++|"{_UNCODED}")*+"{_UNCODED})?+))\\x([0-9a-fA-F]{{2}})"""
)
_SINGLE = rf"""(?s)\G((?:[^'"]++|{_DOUBLE})*+)'((?:[^'\\]++|\\.)*+)'"""
# Words that JSON spells otherwise.
_WORDS = {"None": "null", "True": "true", "False": "false"}


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value, which is computed once however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _outside(skipped: str, wanted: str) -> str:
    """Pattern of something outside of texts in double quotes: what comes before it, then itself."""
    return rf"(?s)\G((?:{skipped}|{_DOUBLE})*+){wanted}"


def _word(word: str) -> str:
    """Pattern of a word among the numbers, words, signs and the rest."""
    others = rf"[-+]?[0-9][0-9.eE+_-]*+|[-+]|(?!{word}(?![A-Za-z0-9_]))[A-Za-z_][A-Za-z0-9_]*+"
    return _outside(rf"""[^"A-Za-z0-9_+-]++|{others}""", word)


def python_text_to_json(text: Column) -> Column:
    """JSON text of a Python literal, or NULL where a quoted text does not end.

    Texts keep what they hold: apostrophes, double quotes and words like None are only touched outside
    of them. Tuples become lists, and a comma before a closing bracket goes.

    Every step is one pass over the whole text, left out where the text has nothing for it.
    """

    def has(mark: str) -> Callable[[Column], Column]:
        return lambda t: t.contains(mark)

    steps = [
        (lambda t: t.contains("'") & t.contains('"'), _BARE_QUOTE, r"$1\\" + '"'),
        (has("'"), _SINGLE, '$1"$2"'),
        # Unless an even number of backslashes comes before the apostrophe.
        (has(r"\'"), r"(?<!\\)((?:\\\\)*)\\'", "$1'"),
        (has(r"\x"), _CODE, r"$1\\u00$2"),
        *[(has(python), _word(python), f"$1{json}") for python, json in _WORDS.items()],
        (has("("), _outside(r'[^"(]++', r"\("), "$1["),
        (has(")"), _outside(r'[^")]++', r"\)"), "$1]"),
        (lambda t: t.rlike(r",\s*[\]}]"), _outside(r"""[^",]++|,(?!\s*[\]}])""", ","), "$1"),
    ]

    def changed(whole: Column) -> Column:
        for needed, pattern, by in steps:
            whole = _once(whole, lambda t: F.when(needed(t), F.regexp_replace(t, pattern, by)).otherwise(t))
        return whole

    def checked(t: Column) -> Column:
        return _once(F.regexp_extract(t, _WHOLE, 0), lambda whole: F.when(F.length(whole) == F.length(t), changed(whole)))

    return _once(text, checked)


def parse_python_text(text: Column, schema) -> Column:
    """Parsed value, or NULL when the repaired text is not valid JSON for the schema."""
    parsed = F.from_json(python_text_to_json(text), schema, {"mode": "PERMISSIVE"})
    return parsed


STRIPPED = "!<>-\\"  # fixed value: characters cut from both ends of a script body


def script_body(html: Column, marker: str) -> Column:
    """Text inside the script tag whose attributes contain `marker`; empty or NULL when there is none.

    Pages without the marker skip the pattern; the body is matched in runs up to the next `<`.
    """
    pattern = rf"<script[^>]*{marker}[^>]*>((?:[^<]++|<(?!/script>))*+)</script>"
    body = F.regexp_extract(html, pattern, 1)
    return F.when(html.contains(marker), F.btrim(body, F.lit(STRIPPED)))
