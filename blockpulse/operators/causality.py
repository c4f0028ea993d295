"""Lag causality and unit-root tests on many series at once.

Lagged values and sums of products are built by Spark windows and aggregations; the per-group
Python step only solves a system of a few dozen numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockpulse.functions import numeric
from blockpulse.operators.moments import gram
from blockpulse.operators.series import difference
from blockpulse.operators.windows import in_order
from blockpulse.session import shared_path
from blockpulse.sources.writers import stored

ALPHA = 0.05


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def paired(long: DataFrame, target: str, features: Sequence[str] | None = None) -> DataFrame:
    """(feature, ts, x, y): each series next to the target on the same date, both present.

    The target's value is spread over its date by a window, so the series are read once.
    """
    is_target = F.col("series_id") == target
    y = F.max(F.when(is_target, F.col("value"))).over(Window.partitionBy("ts"))
    rows = long.withColumn("y", y).where(~is_target & F.col("value").isNotNull() & F.col("y").isNotNull())
    if features is not None:
        rows = rows.where(F.col("series_id").isin(list(features)))
    return rows.select(F.col("series_id").alias("feature"), "ts", F.col("value").alias("x"), "y")


def block_means(pairs: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Average each run of `rows` consecutive pairs before testing."""
    if rows == 1:
        return pairs
    order = Window.partitionBy(*keys).orderBy("ts")
    block = F.floor((F.row_number().over(order) - 1) / rows)
    return pairs.withColumn("_b", block).groupBy(*keys, "_b").agg(
        F.min("ts").alias("ts"), F.avg("x").alias("x"), F.avg("y").alias("y")
    ).drop("_b")


def _standardised(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Centre and scale x and y per group; the test does not depend on either. Constants become 0."""
    over = Window.partitionBy(*keys)

    def scaled(c: str) -> Column:
        spread = F.coalesce(F.nullif(F.stddev_samp(c).over(over), F.lit(0.0)), F.lit(1.0))
        return F.when(F.min(c).over(over) == F.max(c).over(over), F.lit(0.0)).otherwise(
            (F.col(c) - F.avg(c).over(over)) / spread
        )

    return pairs.select(*keys, "ts", scaled("x").alias("x"), scaled("y").alias("y"))


def _lag_vectors(pairs: DataFrame, keys: Sequence[str], max_lag: int) -> DataFrame:
    """One row per (keys, ts, lag): vector [1, effect lags, cause lags, effect] and the oldest date used."""
    pairs = _standardised(pairs, keys)
    order = Window.partitionBy(*keys).orderBy("ts")
    x_past = F.array(*[F.lag("x", k).over(order) for k in range(1, max_lag + 1)])
    y_past = F.array(*[F.lag("y", k).over(order) for k in range(1, max_lag + 1)])
    dates = F.array(*[F.lag("ts", k).over(order) for k in range(1, max_lag + 1)])
    rows = pairs.select(
        *keys, "ts", "y", x_past.alias("_xp"), y_past.alias("_yp"), dates.alias("_dp"),
        F.row_number().over(order).alias("_pos"),
    ).withColumn("lag", F.explode(F.sequence(F.lit(1), F.lit(max_lag)))).where(F.col("_pos") > F.col("lag"))
    vector = F.concat(
        F.array(F.lit(1.0)),
        F.slice("_yp", F.lit(1), F.col("lag")),
        F.slice("_xp", F.lit(1), F.col("lag")),
        F.array("y"),
    )
    return rows.select(*keys, "ts", "lag", vector.alias("v"), F.element_at("_dp", F.col("lag")).alias("start"))


@F.pandas_udf(_doubles("f_stat", "p_value"))
def _granger(grams: pd.Series, n: pd.Series, lag: pd.Series) -> pd.DataFrame:
    out = []
    for g, rows, lags in zip(grams, n, lag):
        size = 2 * lags + 2
        out.append(numeric.granger_f(np.asarray(g, dtype=float).reshape(size, size), rows, lags))
    return pd.DataFrame(out, columns=["f_stat", "p_value"])


def _solved(moments: DataFrame, keep: Sequence[str]) -> DataFrame:
    result = moments.withColumn("_r", _granger("gram", "n", "lag"))
    return result.select(
        *keep,
        F.nanvl(F.col("_r.f_stat"), F.lit(None)).alias("f_stat"),
        F.nanvl(F.col("_r.p_value"), F.lit(None)).alias("p_value"),
    )


def granger(pairs: DataFrame, max_lag: int, keys: Sequence[str] = ("feature",), block: int = 1) -> DataFrame:
    """Does x help to predict y? (keys, lag, n, f_stat, p_value) for lags 1..max_lag.

    `x` is the cause and `y` the effect; swap the columns for the reverse direction.
    """
    keys = list(keys)
    vectors = _lag_vectors(block_means(pairs, keys, block), keys, max_lag)
    return _solved(gram(vectors, [*keys, "lag"], "v"), [*keys, "lag", "n"])


def granger_starts(pairs: DataFrame, max_lag: int) -> DataFrame:
    """The same test for every start date: (feature, start, lag, n, f_stat, p_value).

    A start keeps the rows whose lags also lie on or after it. Each date has one vector [1, effect lags,
    cause lags, effect] at the longest lag; its products summed from the end of the series hold those of
    every shorter lag as a part, so one running total per product serves all lags and starts. Lags from
    before the series count as 0; they are in no part that is used.
    """
    rows = _standardised(pairs, ["feature"])
    order = Window.partitionBy("feature").orderBy("ts")
    lags = range(1, max_lag + 1)
    columns = [F.lit(1.0), *[F.coalesce(F.lag(c, k).over(order), F.lit(0.0)) for c in ("y", "x") for k in lags], F.col("y")]
    dates = F.array(*[F.lag("ts", k).over(order) for k in lags])
    dated = rows.select("feature", "ts", F.array(*columns).alias("v"), dates.alias("starts"))
    upper = F.flatten(F.transform("v", lambda a, i: F.transform(F.slice("v", i + 1, len(columns)), lambda b: a * b)))
    products = dated.select("feature", F.struct("ts", upper.alias("products"), "starts").alias("row"))
    # One array per feature, as long as the calendar: it is walked once from its end.
    newest_first = products.groupBy("feature").agg(F.reverse(F.array_sort(F.collect_list("row"))).alias("rows"))
    none = F.struct(F.array_repeat(F.lit(0.0), len(columns) * (len(columns) + 1) // 2).alias("gram"), F.lit(None).cast(dated.schema["starts"].dataType).alias("starts"))

    def onwards(done: Column, row: Column) -> Column:
        total = F.zip_with(F.element_at(done, -1)["gram"], row["products"], lambda a, b: a + b)
        return F.concat(done, F.array(F.struct(total.alias("gram"), row["starts"].alias("starts"))))

    walked = newest_first.select("feature", F.posexplode(F.aggregate("rows", F.array(none), onwards)).alias("n", "at")).where("n > 0")
    summed = walked.select("feature", F.col("n").cast("long").alias("n"), "at.gram", "at.starts")
    tests = F.arrays_zip("starts", _granger_all_lags("gram", "n").alias("found"))
    each = summed.select("feature", "n", F.posexplode(tests).alias("place", "t")).where("t.starts IS NOT NULL")
    return each.select(
        "feature", F.col("t.starts").alias("start"), (F.col("place") + 1).alias("lag"), "n",
        F.nanvl(F.col("t.found.f_stat"), F.lit(None)).alias("f_stat"),
        F.nanvl(F.col("t.found.p_value"), F.lit(None)).alias("p_value"),
    )


@F.pandas_udf(T.ArrayType(_doubles("f_stat", "p_value")))
def _granger_all_lags(grams: pd.Series, n: pd.Series) -> pd.Series:
    """The tests of lags 1, 2, .. from the flat upper half of products at the longest lag."""
    out = []
    for flat, rows in zip(grams, n):
        size = (math.isqrt(8 * len(flat) + 1) - 1) // 2
        full = np.zeros((size, size))
        full[np.triu_indices(size)] = flat
        full = full + np.triu(full, 1).T
        longest, found = size // 2 - 1, []
        for k in range(1, longest + 1):
            used = [0, *range(1, k + 1), *range(longest + 1, longest + k + 1), size - 1]
            f, p = numeric.granger_f(full[np.ix_(used, used)], rows, k)
            found.append({"f_stat": f, "p_value": p})
        out.append(found)
    return pd.Series(out)


def start_summary(starts: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Mean p-value over lags and number of significant lags per (feature, start)."""
    return starts.groupBy("feature", "start").agg(
        F.avg("p_value").alias("mean_p"),
        F.count_if(F.col("p_value") < alpha).alias("significant_lags"),
    )


def best_start(starts: DataFrame) -> DataFrame:
    """Rows of the start with the smallest mean p-value per feature, the earliest on ties."""
    scored = starts.withColumn("mean_p", F.avg("p_value").over(Window.partitionBy("feature", "start")))
    candidate = F.when(F.col("mean_p").isNotNull(), F.struct("mean_p", "start"))
    best = F.min(candidate).over(Window.partitionBy("feature"))
    return scored.withColumn("_best", best).where(F.col("start") == F.col("_best.start")).drop("_best")


def causality_table(tests: DataFrame, max_lag: int, alpha: float = ALPHA) -> DataFrame:
    """One row per feature: p-value per lag (rounded) and whether it is below alpha."""
    lags = list(range(1, max_lag + 1))
    wide = tests.groupBy("feature").pivot("lag", lags).agg(F.first(F.round("p_value", 6)))
    shown = [c for k in lags for c in (F.col(str(k)).alias(f"lag_{k}"), (F.col(str(k)) < alpha).alias(f"lag_{k}_significant"))]
    return wide.select("feature", *shown)


# --- unit root -------------------------------------------------------------------------------

def _lag_limit(n: Column, most_lags: int) -> Column:
    """Lags tried for n values: ceil(12 (n/100)^(1/4)), at most n/2 - 2 and `most_lags`."""
    rule = F.ceil(12 * F.pow(n / 100, F.lit(0.25)))
    return F.greatest(F.least(rule, F.floor(n / 2) - 2, F.lit(most_lags)), F.lit(0)).cast("int")


def _longest_rule(long: DataFrame, keys: Sequence[str]) -> int:
    """No series is tried with more lags than this: the rule for the longest one, and one more for rounding."""
    counts = long.where("value IS NOT NULL").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    n = counts.agg(F.max("n")).first()[0] or 0
    return math.ceil(12 * (n / 100) ** 0.25) + 1


def _adf_rows(long: DataFrame, keys: Sequence[str], most_lags: int) -> DataFrame:
    """(keys, ts, level, d, past, max_lag): change, previous level and earlier changes, newest first."""
    part = Window.partitionBy(*keys)
    order = part.orderBy("ts")
    present = long.where("value IS NOT NULL")
    step = F.col("value") - F.lag("value").over(order)
    rows = present.withColumns({
        "d": step,
        "level": F.lag("value").over(order),
        "n_values": F.count(F.lit(1)).over(part),
    }).withColumn("max_lag", _lag_limit(F.col("n_values"), most_lags))
    rows = rows.where("d IS NOT NULL")
    past = F.reverse(F.collect_list("d").over(order.rowsBetween(-most_lags, -1)))
    return rows.select(*keys, "ts", "level", "d", past.alias("past"), "max_lag")


def _adf_vector(lags: Column) -> Column:
    return F.concat(F.array(F.lit(1.0), F.col("level")), F.slice("past", F.lit(1), lags), F.array("d"))


@F.pandas_udf(T.IntegerType())
def _best_lag(grams: pd.Series, n: pd.Series, max_lag: pd.Series) -> pd.Series:
    return pd.Series(
        [
            numeric.adf_best_lag(np.asarray(g, dtype=float).reshape(k + 3, k + 3), rows, k)
            for g, rows, k in zip(grams, n, max_lag)
        ],
        dtype="int32",
    )


@F.pandas_udf(_doubles("statistic", "p_value"))
def _adf(grams: pd.Series, n: pd.Series, lags: pd.Series) -> pd.DataFrame:
    out = []
    for g, rows, k in zip(grams, n, lags):
        t = numeric.adf_statistic(np.asarray(g, dtype=float).reshape(k + 3, k + 3), rows, k) if k >= 0 else math.nan
        out.append((t, numeric.adf_pvalue(t)))
    return pd.DataFrame(out, columns=["statistic", "p_value"])


def adf_test(long: DataFrame, keys: Sequence[str] = ("series_id",), most_lags: int | None = None) -> DataFrame:
    """(keys, used_lag, n, statistic, p_value, status): unit-root test with a constant, lag count by AIC.

    Lag counts up to the rule for the series' length, and up to `most_lags` if that is given, are compared
    on one common sample; the chosen one is refitted on all its rows. Every series is in the result: one whose test cannot be computed (constant, exactly
    linear, too short) has the status `untestable` and NULL figures, the others `tested`.
    """
    keys = list(keys)
    return _adf_test(_written(long.select(*keys, "ts", "value")), keys, most_lags)


def _written(long: DataFrame) -> DataFrame:
    """A calendar-sized frame written once: the steps of a test read it several times."""
    return stored(long, shared_path(long.sparkSession, "series"))


def _adf_test(long: DataFrame, keys: list[str], most_lags: int | None) -> DataFrame:
    rows = _adf_rows(long, keys, _longest_rule(long, keys) if most_lags is None else most_lags)
    common = rows.where(F.size("past") >= F.col("max_lag")).withColumn("v", _adf_vector(F.col("max_lag")))
    chosen = gram(common, [*keys, "max_lag"], "v").select(
        *keys, _best_lag("gram", "n", "max_lag").alias("used_lag")
    )
    refit = (
        rows.join(chosen.where("used_lag >= 0"), keys)
        .where(F.size("past") >= F.col("used_lag"))
        .withColumn("v", _adf_vector(F.col("used_lag")))
    )
    result = gram(refit, [*keys, "used_lag"], "v").withColumn("_r", _adf("gram", "n", "used_lag"))
    # A statistic that Python could not compute arrives as NULL.
    tested = result.where(F.col("_r.statistic").isNotNull() & ~F.isnan("_r.statistic")).select(
        *keys, "used_lag", "n", F.col("_r.statistic").alias("statistic"), F.col("_r.p_value").alias("p_value")
    )
    status = F.when(F.col("statistic").isNull(), "untestable").otherwise("tested")
    return long.select(*keys).distinct().join(tested, keys, "left").withColumn("status", status)


MAX_ORDER = 3


def differenced_orders(long: DataFrame, max_order: int = MAX_ORDER) -> DataFrame:
    """(series_id, order, ts, value) for orders 0..max_order."""
    present = long.where("value IS NOT NULL")
    options = F.array(
        *[
            F.struct(F.lit(k).alias("order"), difference(F.col("value"), k).alias("value"))
            for k in range(max_order + 1)
        ]
    )
    return present.select("series_id", "ts", options.alias("_o")).select("series_id", "ts", F.inline("_o"))


def make_stationary(
    long: DataFrame, first_differenced: Sequence[str] = (), max_order: int = MAX_ORDER, alpha: float = ALPHA,
    most_lags: int | None = None,
) -> DataFrame:
    """Difference each series until the unit-root test passes: (series_id, order, ts, value, stationary).

    The listed series are differenced once before anything else. No series is left out: one that
    passes at no order up to `max_order` is returned at that order with `stationary` false, and one
    that cannot be tested at any order is returned as it is with `stationary` NULL.
    """
    if first_differenced:
        order = Window.partitionBy("series_id").orderBy("ts")
        step = F.col("value") - F.lag("value").over(order)
        listed = F.col("series_id").isin(list(first_differenced))
        long = long.withColumn("value", F.when(listed, step).otherwise(F.col("value")))
    options = _written(differenced_orders(long, max_order))
    tests = _adf_test(options, ["series_id", "order"], most_lags)
    passed = F.min(F.when(F.col("p_value") < alpha, F.col("order")))
    needed = tests.groupBy("series_id").agg(passed.alias("passed"), F.count("p_value").alias("tested"))
    chosen = needed.select(
        "series_id",
        F.coalesce("passed", F.when(F.col("tested") > 0, max_order).otherwise(0)).alias("order"),
        F.when(F.col("tested") > 0, F.col("passed").isNotNull()).alias("stationary"),
    )
    return options.join(chosen, ["series_id", "order"]).where("value IS NOT NULL")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _pacf(acf: pd.Series) -> pd.Series:
    return pd.Series([numeric.partial_autocorrelations(list(r)) for r in acf])


def pacf(acf: DataFrame) -> DataFrame:
    """(series_id, lag, pacf) from (series_id, lag, acf)."""
    curves = acf.groupBy("series_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda e: e["acf"]).alias("acf")
    )
    return curves.select("series_id", F.posexplode(_pacf("acf")).alias("lag", "pacf"))


# --- shift search ----------------------------------------------------------------------------


def optimize_shifts(
    wide: DataFrame, ts: str, target: str, features: Sequence[str], fixed: dict[str, int], max_shift: int = 7,
    train_share: float = 0.8,
) -> DataFrame:
    """Test error of a linear model for every combination of feature shifts: (shift per feature, mae).

    All lags of all features enter one Gram matrix over the training rows; a combination is a
    sub-matrix of it. The fitted combinations, `max_shift` to the number of free features, whatever
    the length of the series, meet each held-out row, and errors are averaged by combination.
    """
    over = in_order(ts)
    free = [f for f in features if f not in fixed]
    slots = [(f, k) for f in free for k in range(1, max_shift + 1)] + list(fixed.items())
    lagged = [F.lag(F.col(f), k).over(over) for f, k in slots]
    rows = wide.select(F.col(ts).alias("ts"), F.array(F.lit(1.0), *lagged, F.col(target)).alias("v"))
    rows = rows.where(F.forall("v", lambda x: x.isNotNull()))
    rows = rows.withColumn("_share", F.percent_rank().over(in_order("ts")))
    train, test = rows.where(F.col("_share") <= train_share), rows.where(F.col("_share") > train_share)
    moments = gram(train.withColumn("one", F.lit(1)), ["one"], "v").select("gram").scalar()

    position = {slot: i + 1 for i, slot in enumerate(slots)}
    shift_columns = {f: (F.floor(F.col("id") / max_shift**i) % max_shift + 1).cast("int") for i, f in enumerate(free)}
    shift_columns |= {f: F.lit(k) for f, k in fixed.items()}
    grid = wide.sparkSession.range(max_shift ** len(free)).select("id", *[shift_columns[f].alias(f) for f in features])
    columns = [F.lit(position[(f, 1)]) + F.col(f) - 1 if f in free else F.lit(position[(f, fixed[f])]) for f in features]
    solved = grid.withColumns({"_cols": F.array(F.lit(0), *columns).cast("array<int>"), "_gram": moments})
    solved = solved.select("id", *features, "_cols", _solve_subset("_gram", "_cols").alias("_beta"))

    models = solved.agg(F.collect_list(F.struct("id", "_cols", "_beta")).alias("models")).scalar()
    tried = test.select("v", F.inline(models))
    terms = F.zip_with("_beta", "_cols", lambda b, c: b * F.get("v", c))
    miss = F.abs(F.element_at("v", -1) - F.aggregate(terms, F.lit(0.0), lambda a, t: a + t))
    errors = tried.select("id", miss.alias("miss")).groupBy("id").agg(F.avg("miss").alias("mae"))
    return solved.join(errors, "id", "left").select(*features, "mae")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _solve_subset(grams: pd.Series, columns: pd.Series) -> pd.Series:
    if not len(grams):
        return pd.Series([], dtype=object)
    flat = np.asarray(grams.iloc[0], dtype=float)
    size = math.isqrt(len(flat))
    g = flat.reshape(size, size)
    return pd.Series([numeric.ssr_from_gram(g, list(c), size - 1)[1] for c in columns])
