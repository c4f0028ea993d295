"""Python literals against the language's own reader; seasons of even length against a direct version."""

import ast
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from blockpulse.functions import nested
from blockpulse.operators import series as ser


def as_lists(x):
    if isinstance(x, (list, tuple)):
        return [as_lists(v) for v in x]
    return {k: as_lists(v) for k, v in x.items()} if isinstance(x, dict) else x


def made(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 6)
    if kind < 3:
        return "".join(rng.choice(["None", "True", "'", '"', "\\", "\n", "é", " ", "a", ",)", "(", "x41", "\x7f", "None Such", "It's"]) for _ in range(rng.randrange(6)))
    if kind == 3:
        return rng.choice([None, True, False])
    if kind == 4:
        return rng.randrange(-1000, 1000)
    if kind == 5:
        return rng.choice([0.5, -1e-07, 3e20, -2.25])
    if kind == 6:
        values = [made(rng, depth + 1) for _ in range(rng.randrange(4))]
        return tuple(values) if rng.random() < 0.5 else values
    return {made_key(rng): made(rng, depth + 1) for _ in range(rng.randrange(4))}


def made_key(rng):
    return rng.choice(["a", "it's", 'q"', "None", "k1"])


def test_literals_match_the_language(spark):
    rng = random.Random(3)
    values = [made(rng) for _ in range(800)]
    texts = [repr(v) for v in values] + ["{'a': (1,), }", "[1, 2,]", '("x", \'y\')', "{'long': '" + "n\\'" * 50_000 + "'}"]
    values += [{"a": [1]}, [1, 2], ["x", "y"], {"long": "n'" * 50_000}]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in rows.select("id", nested.python_text_to_json(F.col("t")).alias("j")).collect():
        assert as_lists(ast.literal_eval(texts[r.id])) == as_lists(values[r.id])
        assert json.loads(r.j) == as_lists(values[r.id]), texts[r.id][:200]


@pytest.mark.parametrize("text", ["['cut", "{'a': \"x}", "'\\'", None])
def test_texts_that_never_end(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(nested.python_text_to_json(F.col("t")).alias("j")).first()
    assert row.j is None


@pytest.mark.parametrize(
    ("text", "json_text"),
    [
        # Code points, quotes and words right beside each other, in both kinds of quotes.
        (r"""['\x41\x42"', "\x43'\\x44"]""", r"""["\u0041\u0042\"", "\u0043'\\x44"]"""),
        (r"""['""', 'a"b\"c', "d", '"']""", r"""["\"\"", "a\"b\"c", "d", "\""]"""),
        (r"""['\\', 'It\'s\\\'', "\'"]""", r"""["\\", "It's\\'", "'"]"""),
        # Words are words only between what is no letter, digit or underscore; numbers end before them.
        ("[None,None1,_None,1None,NoneNone,True,éFalse]", "[null,None1,_None,1null,NoneNone,true,éfalse]"),
        ("((1,), (), {'a': (2, )}, ',)', \",]\",)", """[[1], [], {"a": [2 ]}, ",)", ",]"]"""),
        # Outside of texts a backslash means nothing.
        (r"[\x41, '\x41']", r"""[\x41, "\u0041"]"""),
        ("", ""),
    ],
)
def test_texts_keep_what_they_hold(spark, text, json_text):
    row = spark.createDataFrame([(text,)], "t string").select(nested.python_text_to_json(F.col("t")).alias("j")).first()
    assert row.j == json_text


def test_bytes_that_are_no_text(spark):
    rows = spark.createDataFrame([(bytearray(b"['caf\xe9']"),)], "b binary").selectExpr("CAST(b AS STRING) AS t")
    assert rows.select(nested.python_text_to_json(F.col("t")).alias("j")).first().j is None


def test_a_text_is_converted_and_parsed_once(spark, sf):
    """The summary has four columns and names the parsed list six times."""
    plan = entry_points.queries()["repair_json"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    # One look for each step, none of them on a piece of the text.
    assert "regexp_extract_all" not in plan
    assert plan.count("regexp_replace(") == 10


@pytest.mark.parametrize("period", [2, 4, 7, 12])
def test_seasons(spark, period):
    rng = np.random.default_rng(period)
    values = rng.normal(size=50).cumsum()
    rows = spark.createDataFrame([("s", k, float(v)) for k, v in enumerate(values)], "series_id string, ts int, value double")
    found = ser.seasonal_decompose(rows, period).orderBy("ts").collect()
    weights = np.ones(period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5]
    half, trend = period // 2, np.full(50, np.nan)
    for t in range(half, 50 - half):
        trend[t] = weights @ values[t - half : t + half + 1] / period
    means = np.array([np.nanmean((values - trend)[p::period]) for p in range(period)])
    means -= means.mean()
    for t, r in enumerate(found):
        assert (r.trend is None) == np.isnan(trend[t])
        assert r.seasonal == pytest.approx(means[t % period])
        if r.trend is not None:
            assert r.trend == pytest.approx(trend[t]) and r.residual == pytest.approx(values[t] - trend[t] - means[t % period])
