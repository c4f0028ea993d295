"""Small hand-made frames, one per semantic trap."""

from datetime import date

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from blockpulse.functions import calendar as cal
from blockpulse.functions import nested
from blockpulse.functions import values as val
from blockpulse.operators import aggregates, filters, joins
from blockpulse.operators import models as mod
from blockpulse.operators import ranking
from blockpulse.operators import series as ser
from blockpulse.operators import windows as win
from blockpulse.operators.panel import Feed, aligned_panel


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(expr.alias("v")).first()["v"]


def test_rank_puts_missing_rate_first(spark):
    df = spark.createDataFrame([("a", None), ("a", 3.0), ("a", 1.0)], "trend string, roc double")
    top = {r["roc"]: r["rank"] for r in win.top_ranked(df, "trend", "roc", 2).collect()}
    assert top == {None: 1, 3.0: 2}


def test_dates_padded_unpadded_and_impossible(spark):
    df = spark.createDataFrame([("01/05/2020",), ("1/5/2020",), ("13/45/2020",), (None,)], "t string")
    got = [r[0] for r in df.select(cal.us_date(F.col("t"))).collect()]
    assert got == [date(2020, 1, 5), date(2020, 1, 5), None, None]


def test_day_of_month_not_of_year(spark):
    assert one(spark, cal.day_text(F.lit(date(2021, 2, 3)))) == "2021-02-03"


@pytest.mark.parametrize("day,key", [(date(2021, 1, 1), "2020-53"), (date(2018, 12, 31), "2019-01"), (date(2020, 6, 1), "2020-23")])
def test_iso_week_belongs_to_its_own_year(spark, day, key):
    assert one(spark, cal.iso_week(F.lit(day))) == key


def test_week_ends_on_sunday(spark):
    ends = [one(spark, cal.period_end(F.lit(date(2020, 6, d)), "W")) for d in (1, 7, 8)]
    assert ends == [date(2020, 6, 7), date(2020, 6, 7), date(2020, 6, 14)]


def test_number_coercion(spark):
    df = spark.createDataFrame([("12.0",), ("bad",), ("nan",), (None,), ("-3.9",)], "t string")
    assert [r[0] for r in df.select(val.to_whole_number(F.col("t"))).collect()] == [12, None, None, None, -3]


def test_fee_text(spark):
    df = spark.createDataFrame([("HOA Fee: $1,250 monthly",), ("nan",), (None,), ("$ 3.5",)], "t string")
    assert [r[0] for r in df.select(val.clean_fee(F.col("t"))).collect()] == [1250.0, None, None, 3.5]


def test_tract_bins(spark):
    df = spark.createDataFrame([(0,), (1,), (10000,), (10001,), (300000,), (300001,), (None,)], "t int")
    assert [r[0] for r in df.select(val.tract_bin(F.col("t"))).collect()] == [None, 1, 1, 2, 30, None, None]


def test_grades(spark):
    df = spark.createDataFrame([(13.9,), (14.0,), (27.0,), (27.5,), (None,)], "s double")
    assert [r[0] for r in df.select(val.inspection_grade(F.col("s"))).collect()] == ["A", "B", "B", "C", None]


def test_price_metrics(spark):
    df = spark.createDataFrame([(100, 4, 50), (100, 0, 0), (100, None, None)], "p bigint, u bigint, a bigint")
    got = [tuple(r) for r in df.select(val.price_per_unit(F.col("p"), F.col("u")), val.price_per_area(F.col("p"), F.col("a"))).collect()]
    assert got == [(25.0, 2.0), (100.0, 0.0), (100.0, None)]


def test_borough_codes_row_by_row(spark):
    df = spark.createDataFrame([("1",), ("Queens",), ("5",), ("9",)], "b string")
    assert [r[0] for r in df.select(val.borough_name(F.col("b"))).collect()] == ["Manhattan", "Queens", "Staten Island", "9"]


def test_names(spark):
    df = spark.createDataFrame([("Ann Mary Lee",), ("Solo",), ("",), (None,), ("Jo Ann-De Vries",)], "n string")
    got = [tuple(r) for r in df.select(val.first_name(F.col("n")), val.last_name(F.col("n")), val.lead_last_name(F.col("n"))).collect()]
    assert got[0] == ("Ann", "Lee", "Lee")
    assert got[1][:2] == ("Solo", None)
    assert got[2][:2] == (None, None)
    assert got[3] == (None, None, None)
    assert got[4] == ("Jo", "Vries", "Vries")


def test_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(F.bround("x", 0)).collect()] == [0.0, 2.0, 2.0, -2.0]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.1), (2.0, 0.1), (3.0, 0.1), (None, 0.7)], "a double, b double")
    assert df.agg(aggregates.safe_corr(F.col("a"), F.col("b"))).first()[0] is None


def test_matrix_is_symmetric_with_unit_diagonal(spark):
    df = spark.createDataFrame([(1.0, 2.0, 9.0), (2.0, 1.0, 4.0), (3.0, 5.0, None), (4.0, 3.0, 1.0)], "a double, b double, c double")
    m = {r["feature"]: r for r in aggregates.corr_matrix(df, ["a", "b", "c"]).collect()}
    for x in "abc":
        assert m[x][x] == 1.0
        for y in "abc":
            assert m[x][y] == m[y][x]
            assert abs(m[x][y]) <= 1.0
    assert m["a"]["c"] == pytest.approx(pd.DataFrame({"a": [1, 2, 4], "c": [9, 4, 1]}).corr().iloc[0, 1])


def test_histogram_maximum_is_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(26)], "x double, flat double")
    got = {(r["feature"], r["bin"]): r["n"] for r in aggregates.histogram(df, ["x", "flat"]).collect()}
    assert got[("x", 25)] == 2 and got[("x", 1)] == 1
    assert got[("flat", 1)] == 26
    assert max(b for f, b in got if f == "x") == 25


def test_panel_keeps_spine_days_and_leaves_gaps_null(spark):
    sales = spark.createDataFrame([(date(2020, 1, 1), 10), (date(2020, 1, 1), 30), (date(2020, 1, 3), None)], "d date, p bigint")
    events = spark.createDataFrame([(date(2020, 1, 1),), (date(2020, 1, 2),)], "d date")
    feeds = [
        Feed("sales", sales, F.col("d"), "total", "mean", measure=F.col("p")),
        Feed("events", events, F.col("d"), "events"),
    ]
    rows = aligned_panel(feeds, lambda d: d, "day", "sales").orderBy("day").collect()
    assert [tuple(r) for r in rows] == [(date(2020, 1, 1), 2, 20.0, 1), (date(2020, 1, 3), 1, None, None)]


def test_panel_rejects_repeated_daily_values(spark):
    sales = spark.createDataFrame([(date(2020, 1, 1), 10)], "d date, p bigint")
    rides = spark.createDataFrame([(date(2020, 1, 1), 5), (date(2020, 1, 1), 6)], "d date, n bigint")
    feeds = [
        Feed("sales", sales, F.col("d"), "total"),
        Feed("rides", rides, F.col("d"), value_as="rides", measure=F.col("n")),
    ]
    with pytest.raises(PySparkException, match="more than one row per key"):
        aligned_panel(feeds, lambda d: d, "day", "sales").collect()


def test_lookup_rejects_a_repeated_key(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(PySparkException, match="repeated join key"):
        joins.lookup(left, right, ["k"], ["v"]).collect()


def test_quiet_ranges_are_inclusive(spark):
    days = [date(2020, 9, 30), date(2020, 10, 1), date(2020, 11, 1), date(2020, 11, 2)]
    df = spark.createDataFrame([(d, 1, 1) for d in days], "day date, new_businesses int, new_restaurants int")
    got = [(r["new_businesses"], r["new_restaurants"]) for r in filters.nullify_ranges(df, "day").orderBy("day").collect()]
    assert got == [(1, None), (None, None), (None, 1), (1, 1)]


def test_latest_scrape_is_by_time_not_by_text(spark):
    from blockpulse.operators.documents import newest_scrape

    rows = [(1, "31/01/2020 10:00:00", "old"), (1, "02/02/2020 09:00:00", "new")]
    df = spark.createDataFrame(rows, "zpid int, stamp string, v string")
    assert newest_scrape(df, "zpid", "stamp").first()["v"] == "new"


def test_lead_filters_come_after_the_dedupe(spark):
    from blockpulse.plans.documents import lead_list

    columns = "lead_id bigint, agent_name string, price double, street string, city string, zipcode string, state string, agent_email string, agent_phone string, days_listed bigint"
    rows = [
        (1, "Ann Lee", 900.0, "s", "c", "z", "NY", None, "p", 3),
        (2, "Ann Lee", 500.0, "s", "c", "z", "NY", "a@b", "p", 3),
        (3, "Bob Team", 800.0, "s", "c", "z", "NY", "b@b", "p", 3),
        (4, None, 700.0, "s", "c", "z", "NY", "n@b", "p", 3),
        (5, "Cy Roe", 1234567.0, "s", "c", "z", "NY", "c@b", "p", 364),
        (6, "Di Poe", 50.0, "s", "c", "z", "NY", "d@b", "p", 365),
    ]
    got = [(r["LeadId"], r["Price"]) for r in lead_list(spark.createDataFrame(rows, columns)).collect()]
    assert got == [(5, "$1,234,567")]


def test_repaired_text(spark):
    schema = "array<struct<name: string, rating: int>>"
    df = spark.createDataFrame([("[{'name': 'None Such', 'rating': None}]",), ("[{'name': ",), (None,)], "t string")
    got = [r[0] for r in df.select(nested.parse_python_text(F.col("t"), schema)).collect()]
    assert got[0][0]["rating"] is None
    assert got[1] is None or got[1][0]["name"] is None
    assert got[2] is None


def test_empty_and_missing_arrays(spark):
    df = spark.createDataFrame([([],), (None,), ([(0.5,)],)], "a array<struct<percentile: double>>")
    assert [r[0] for r in df.select(nested.first_field(F.col("a"), "percentile")).collect()] == [None, None, 0.5]
    assert [r[0] for r in df.select(nested.mean_of_field(F.col("a"), "percentile")).collect()] == [None, None, 0.5]


def test_resample_keeps_empty_bins(spark):
    df = spark.createDataFrame([("s", date(2020, 1, 15), 4.0), ("s", date(2020, 1, 20), 6.0), ("s", date(2020, 4, 2), 1.0)], "series_id string, ts date, value double")
    got = [(r["ts"], r["value"]) for r in ser.resample(df, "M").orderBy("ts").collect()]
    assert got == [(date(2020, 1, 31), 5.0), (date(2020, 2, 29), None), (date(2020, 3, 31), None), (date(2020, 4, 30), 1.0)]


def test_nan_becomes_null_on_entry(spark):
    df = spark.createDataFrame([(date(2020, 1, 1), float("nan")), (date(2020, 1, 2), 1.0)], "d date, x double")
    assert [r["value"] for r in ser.to_long(df, "d", ["x"]).orderBy("ts").collect()] == [None, 1.0]


def test_long_and_wide_forms_agree(spark):
    wide = spark.createDataFrame([(date(2020, 1, 1), 1.0, None), (date(2020, 1, 2), 2.0, 5.0)], "ts date, a double, b double")
    back = ser.to_wide(ser.to_long(wide, "ts", ["a", "b"]), ["a", "b"]).orderBy("ts")
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in wide.collect()]


def test_constant_series_scale(spark):
    df = spark.createDataFrame([("c", date(2020, 1, d), 7.0) for d in (1, 2, 3)], "series_id string, ts date, value double")
    assert [r["value"] for r in ser.minmax(df).collect()] == [0.0, 0.0, 0.0]
    assert [r["value"] for r in ser.zscore(df).collect()] == [None, None, None]


def _long(spark, values):
    days = pd.date_range("2020-01-01", periods=len(values), freq="D").date
    return spark.createDataFrame(pd.DataFrame({"series_id": "s", "ts": days, "value": values}))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(-1000, 1000), min_size=12, max_size=30))
def test_decomposition_adds_up(spark, values):
    rows = ser.seasonal_decompose(_long(spark, values), 7).where("trend IS NOT NULL").collect()
    assert len(rows) == len(values) - 6
    for r in rows:
        assert r["trend"] + r["seasonal"] + r["residual"] == pytest.approx(r["value"], abs=1e-6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-1000, 1000), min_size=5, max_size=25, unique=True))
def test_zscore_has_mean_zero_and_unit_spread(spark, values):
    got = ser.zscore(_long(spark, [float(v) for v in values])).agg(F.avg("value"), F.stddev_samp("value")).first()
    assert got[0] == pytest.approx(0, abs=1e-9) and got[1] == pytest.approx(1, abs=1e-9)


def test_lag_then_lead_is_identity(spark):
    wide = spark.createDataFrame(pd.DataFrame({"ts": pd.date_range("2020-01-01", periods=9).date, "x": range(9)}))
    moved = ser.shift_features(wide, "ts", {"x": 2})
    back = moved.select("ts", F.lead("x", 2).over(win.in_order("ts")).alias("x")).orderBy("ts")
    assert [r["x"] for r in back.collect()] == [0, 1, 2, 3, 4, 5, 6, None, None]


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0), (None, 1.0)], "y double, p double")
    m = mod.evaluate(df, "y", "p").first()
    assert m["mae"] == pytest.approx(2 / 3)
    assert m["mse"] == pytest.approx(2 / 3)
    assert m["r2"] == pytest.approx(1 - 2 / (14 / 3))
    assert m["mape"] == pytest.approx((1 + 0 + 0.25) / 3 * 100)


def test_codes_follow_sort_order(spark):
    df = spark.createDataFrame([("b", 2.5, True), ("a", 10.0, False), ("c", 2.5, None), ("b", None, True)], "t string, x double, f boolean")
    got = sorted((tuple(r) for r in ranking.label_encode(df, ["t", "x", "f"]).collect()), key=str)
    assert got == sorted([(1, 0, 1), (0, 1, 0), (2, 0, None), (1, None, 1)], key=str)
