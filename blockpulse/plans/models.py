"""Price models, with and without the extra signals, and their evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockpulse.fixtures import table
from blockpulse.functions import calendar as cal
from blockpulse.functions import nested
from blockpulse.functions import values as val
from blockpulse.listing_fixture import payloads
from blockpulse.operators import aggregates, filters, ranking
from blockpulse.operators import models as mod
from blockpulse.operators import moment_models
from blockpulse.operators.series import shift_features
from blockpulse.operators.windows import in_order, with_global_stats
from blockpulse.oracle import define
from blockpulse.oracle.regression import least_squares_sql
from blockpulse.plans.panels import rounded
from blockpulse.plans.registry import query
from blockpulse.plans.series import ALL_SIGNALS, FEATURES, SHIFTS, signals
from blockpulse.session import shared_path
from blockpulse.sources import writers

# The columns of the listing model, in order.
MODEL_COLUMNS = [
    "price", "arm5Rate", "homeType", "propertyTaxRate", "hasGarage", "parkingCapacity", "favoriteCount", "pageViewCount",
    "daysListed", "hasHeating", "overviewTaxRate", "latitude", "bedrooms", "yearBuilt", "zipcode", "longitude", "bathrooms", "hoaFee",
    "avgPriceChange", "avgSchoolRating", "zestimate", "sellingSoon",
]
ENCODED = ["homeType", "hasHeating", "hasGarage", "zipcode", "arm5Rate", "propertyTaxRate"]


def raw_model_frame(spark: SparkSession, sf: str) -> DataFrame:
    """(scrape_id, model columns) before rows with missing values are dropped."""
    p = "p."
    column = {
        "arm5Rate": (F.col("scrape_id") % 8) / 16 + 3,
        "overviewTaxRate": (F.col("scrape_id") % 7) / 4 + 0.5,
        "hasGarage": F.col("p.resoFacts.hasGarage"),
        "hasHeating": F.col("p.resoFacts.hasHeating"),
        "homeType": F.col("p.resoFacts.homeType"),
        "parkingCapacity": F.col("p.resoFacts.parkingCapacity"),
        "bedrooms": F.col("p.resoFacts.bedrooms"),
        "bathrooms": F.col("p.resoFacts.bathrooms"),
        "yearBuilt": F.col("p.resoFacts.yearBuilt"),
        "hoaFee": val.clean_fee(F.col("p.resoFacts.hoaFee")),
        "avgPriceChange": nested.mean_of_field(F.col("p.priceHistory"), "priceChangeRate", 4),
        "avgSchoolRating": nested.mean_of_field(F.col("p.schools"), "rating", 4),
        "sellingSoon": nested.first_field(F.col("p.sellingSoon"), "percentile"),
    }
    return payloads(spark, sf).select(
        "scrape_id", *[column.get(c, F.col(p + c)).alias(c) for c in MODEL_COLUMNS]
    )


def model_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Complete rows, prices below the ceiling, ratings rounded half to even."""
    complete = raw_model_frame(spark, sf).dropna(subset=MODEL_COLUMNS)
    rated = complete.withColumn("avgSchoolRating", F.bround("avgSchoolRating", 0).cast("int"))
    return filters.max_value_filter(rated, "price")


def encoded_frame(spark: SparkSession, sf: str) -> DataFrame:
    """The model frame with category columns as codes, encoded in place.

    The cleaned rows and the encoded rows are each written once: fitting reads its input many
    times, and a narrow stored frame is cheaper to read again than nested documents.
    """
    cleaned = writers.stored(model_frame(spark, sf), shared_path(spark, "model-frame"))
    filled = mod.replace_zero_with_mean(cleaned, "propertyTaxRate")
    return writers.stored(ranking.label_encode(filled, ENCODED), shared_path(spark, "encoded-frame"))


define(
    "model_rows",
    """
    SELECT s.n AS scrape_id, s.price, (s.n % 8) / 16 + 3 AS arm5Rate,
           CASE c % 4 WHEN 0 THEN 'CONDO' WHEN 1 THEN 'HOUSE' WHEN 2 THEN 'TOWNHOUSE' ELSE 'COOP' END AS homeType,
           (s.n % 5) / 4 AS propertyTaxRate, s.n // 16 % 2 = 0 AS hasGarage, s.n // 4 % 4 AS parkingCapacity, s.n % 37 AS favoriteCount,
           s.n % 211 AS pageViewCount, s.n % 500 AS daysListed, s.n % 3 <> 0 AS hasHeating, (s.n % 7) / 4 + 0.5 AS overviewTaxRate, 40.0 + (c % 90) / 1000 AS latitude,
           1 + CAST(FLOOR(amount / 120000) AS BIGINT) AS bedrooms, 1900 + c % 120 AS yearBuilt,
           CAST(10000 + c % 250 AS VARCHAR) AS zipcode, -74.0 + (c % 100) / 1000 AS longitude,
           1 + s.n % 2 + FLOOR(amount / 200000) AS bathrooms,
           CASE s.n % 4 WHEN 0 THEN CAST(s.n AS DOUBLE) WHEN 1 THEN s.n + 0.5 END AS hoaFee, pc.m AS avgPriceChange,
           sc.m AS rating, CASE WHEN s.n % 23 <> 0 THEN CAST(FLOOR(amount * (90 + s.n % 21) / 100) AS BIGINT) END AS zestimate,
           CASE WHEN s.n % 6 > 1 THEN s.n % 100 / 100 END AS sellingSoon
    FROM scrapes s
    LEFT JOIN (SELECT n, ROUND(AVG(rate), 4) AS m FROM price_items GROUP BY 1) pc ON pc.n = s.n
    LEFT JOIN (SELECT n, ROUND(AVG(rating), 4) AS m FROM school_items GROUP BY 1) sc ON sc.n = s.n
    WHERE pc.m IS NOT NULL AND sc.m IS NOT NULL AND s.n % 4 < 2 AND s.n % 23 <> 0 AND s.n % 6 > 1 AND s.price < 40000000
    """,
)
define(
    "tax_filled",
    "SELECT * REPLACE (CASE WHEN propertyTaxRate = 0 THEN AVG(propertyTaxRate) OVER () ELSE propertyTaxRate END AS propertyTaxRate) FROM model_rows",
)


@query("max_value_filter", "SELECT scrape_id, price FROM model_rows WHERE price < 40000000")
def max_value_filter(spark, sf):
    return model_frame(spark, sf).select("scrape_id", "price")


@query(
    "round_half_even",
    """SELECT scrape_id, rating, CAST(CASE WHEN rating - FLOOR(rating) = 0.5 THEN 2 * ROUND(rating / 2)
    ELSE ROUND(rating) END AS INTEGER) AS rounded
    FROM (SELECT s.n AS scrape_id, sc.m AS rating FROM scrapes s
          JOIN (SELECT n, ROUND(AVG(rating), 4) AS m FROM school_items GROUP BY 1) sc ON sc.n = s.n WHERE sc.m IS NOT NULL)""",
)
def round_half_even(spark, sf):
    rows = raw_model_frame(spark, sf).select("scrape_id", F.col("avgSchoolRating").alias("rating")).dropna()
    return rows.withColumn("rounded", F.bround("rating", 0).cast("int"))


@query("replace_zero_with_mean", "SELECT scrape_id, ROUND(propertyTaxRate, 6) AS propertyTaxRate FROM tax_filled")
def replace_zero_with_mean(spark, sf):
    filled = mod.replace_zero_with_mean(model_frame(spark, sf), "propertyTaxRate")
    return rounded(filled.select("scrape_id", "propertyTaxRate"), 6)


@query(
    "label_encode",
    "SELECT scrape_id, " + ", ".join(f"DENSE_RANK() OVER (ORDER BY {c}) - 1 AS {c}" for c in ENCODED) + " FROM tax_filled",
)
def label_encode(spark, sf):
    return encoded_frame(spark, sf).select("scrape_id", *ENCODED)


def _assembled(spark, sf, target: str, dropped: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    features = [c for c in MODEL_COLUMNS if c != target and c not in dropped]
    return mod.assemble(encoded_frame(spark, sf), features, target, ["scrape_id"]), features


@query(
    "feature_select",
    "SELECT scrape_id, price AS label, CAST(19 AS INTEGER) AS n_features, 'daysListed,zestimate' AS excluded FROM tax_filled",
)
def feature_select(spark, sf):
    """Features chosen by flags; what was left out is recorded."""
    flags = {c: c not in ("zestimate", "daysListed") for c in MODEL_COLUMNS}
    features, excluded = mod.selected_features(flags, "price")
    rows = mod.assemble(encoded_frame(spark, sf), features, "price", ["scrape_id"])
    return rows.select(
        "scrape_id", F.col("label").cast("bigint").alias("label"), F.size(vector_to_array("features")).alias("n_features"),
        F.lit(",".join(excluded)).alias("excluded"),
    )


_BUCKET_SQL = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100"


@query(
    "split",
    f"SELECT o_orderkey AS sale_id, CASE WHEN {_BUCKET_SQL} < 20 THEN 'test' ELSE 'train' END AS part FROM orders",
)
def split(spark, sf):
    """80/20 by key hash: the same rows on every run."""
    sales = table(spark, sf, "orders").select(F.col("o_orderkey").alias("sale_id"))
    train, test = mod.hash_split(sales, "sale_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


define(
    "timed_signals",
    "SELECT *, ROW_NUMBER() OVER (ORDER BY month) - 1 AS pos, COUNT(*) OVER () AS total FROM signals",
)


def timed(rows: DataFrame, ts: str, share: float = 0.8) -> DataFrame:
    """A calendar series with `is_train`: the first floor(share * n) rows."""
    whole = Window.partitionBy()
    cut = F.floor(F.count(F.lit(1)).over(whole) * F.lit(share))
    return rows.withColumn("is_train", F.row_number().over(in_order(ts)) <= cut)


@query("split_by_time", "SELECT month, pos < FLOOR(total * 0.8) AS is_train FROM timed_signals")
def split_by_time(spark, sf):
    return timed(signals(spark, sf), "month").select("month", "is_train")


# --- metrics ---------------------------------------------------------------------------------

_METRICS_SQL = """ROUND(AVG(ABS(y - p)), 4) AS mae, ROUND(AVG((y - p) ** 2), 2) AS mse, ROUND(SQRT(AVG((y - p) ** 2)), 4) AS rmse,
    ROUND(1 - SUM((y - p) ** 2) / SUM((y - m) ** 2), 6) AS r2, ROUND(AVG(ABS((y - p) / y)) * 100, 6) AS mape,
    ROUND(AVG(2 * ABS(y - p) / (ABS(y) + ABS(p))) * 100, 6) AS smape, ROUND(SQRT(AVG((ln(1 + p) - ln(1 + y)) ** 2)), 6) AS rmsle"""
_DIGITS = {"mae": 4, "mse": 2, "rmse": 4, "r2": 6, "mape": 6, "smape": 6, "rmsle": 6}


def shown_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({m: F.round(F.col(m), d) for m, d in _DIGITS.items()})


@query(
    "regression_metrics",
    f"""SELECT state, {_METRICS_SQL}
    FROM (SELECT *, AVG(y) OVER (PARTITION BY state) AS m FROM (
        SELECT state, CAST(price AS DOUBLE) AS y, CAST(FLOOR(amount * (90 + n % 21) / 100) AS DOUBLE) AS p FROM scrapes WHERE n % 23 <> 0))
    GROUP BY state""",
)
def regression_metrics(spark, sf):
    """All seven metrics of the listing estimate against the price, per state."""
    rows = payloads(spark, sf).select("p.state", "p.price", "p.zestimate")
    return shown_metrics(mod.evaluate(rows, "price", "zestimate", ["state"]))


@query(
    "residual_trend",
    """SELECT n AS scrape_id, y AS actual, p AS predicted, ROUND(a + b * y, 2) AS trend, ROUND(y - p, 2) AS residual,
    ROUND(r2, 6) AS r2 FROM (
      SELECT n, y, p, regr_intercept(p, y) OVER () AS a, regr_slope(p, y) OVER () AS b, regr_r2(p, y) OVER () AS r2
      FROM (SELECT n, CAST(price AS DOUBLE) AS y, CAST(FLOOR(amount * (90 + n % 21) / 100) AS DOUBLE) AS p FROM scrapes WHERE n % 23 <> 0))""",
)
def residual_trend(spark, sf):
    """Predicted over actual with a straight trend line through it."""
    rows = payloads(spark, sf).select(
        "scrape_id", F.col("p.price").cast("double").alias("actual"), F.col("p.zestimate").cast("double").alias("predicted")
    ).dropna()
    varies = F.stddev_samp("predicted") > 0
    lined = with_global_stats(
        rows,
        {
            "a": F.regr_intercept("predicted", "actual"),
            "b": F.regr_slope("predicted", "actual"),
            "r2": F.when(varies, F.regr_r2("predicted", "actual")),
        },
    )
    return lined.select(
        "scrape_id", "actual", "predicted",
        F.round(F.col("stats.a") + F.col("stats.b") * F.col("actual"), 2).alias("trend"),
        F.round(F.col("actual") - F.col("predicted"), 2).alias("residual"),
        F.round("stats.r2", 6).alias("r2"),
    )


# --- learners on the listing frame -----------------------------------------------------------


@query("gbt_price")
def gbt_price(spark, sf):
    """Monthly price index from unshifted signals: boosted trees, test predictions."""
    stored = writers.stored(signals(spark, sf), shared_path(spark, "signals"))
    rows = mod.assemble(stored, ALL_SIGNALS[1:], "avg_sales", ["month"])
    train, test = mod.hash_split(rows, "month")
    model = mod.fit(mod.boosted_trees(mod.MARKET_BOOST), train)
    return rounded(mod.predictions(model, test, ["month"]))


@query("gbt_price_shifted")
def gbt_price_shifted(spark, sf):
    """The same learner on shifted signals: metrics on the test months."""
    shifted = writers.stored(shift_features(signals(spark, sf), "month", SHIFTS), shared_path(spark, "shifted"))
    rows = mod.assemble(shifted, ALL_SIGNALS[1:], "avg_sales", ["month"])
    train, test = mod.hash_split(rows, "month")
    model = mod.fit(mod.boosted_trees(mod.MARKET_BOOST), train)
    return shown_metrics(mod.evaluate(mod.predictions(model, test, []), "actual", "predicted"))


@query("gbt_zestimate")
def gbt_zestimate(spark, sf):
    """The listing estimate from listing features without the price: test predictions."""
    rows, _ = _assembled(spark, sf, "zestimate", ("price",))
    train, test = mod.hash_split(rows, "scrape_id")
    model = mod.fit(mod.boosted_trees(mod.LISTING_BOOST), train)
    return rounded(mod.predictions(model, test, ["scrape_id"]))


LINEAR_FEATURES = [c for c in MODEL_COLUMNS if c not in ("price", "zestimate")]
_TRAIN_SQL = "CAST('0x' || substr(md5(CAST(scrape_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 20"
_ENCODED_SQL = (
    "SELECT * REPLACE (" + ", ".join(f"DENSE_RANK() OVER (ORDER BY {c}) - 1 AS {c}" for c in ENCODED) + "), "
    "CASE WHEN rating - FLOOR(rating) = 0.5 THEN 2 * ROUND(rating / 2) ELSE ROUND(rating) END AS avgSchoolRating FROM tax_filled"
)


def _with_fits(fits: dict[str, list[str]]) -> tuple[str, dict[str, list[str]]]:
    """Opening of a statement with one fit per prefix, and the step names of each fit."""
    named = [("encoded_rows", _ENCODED_SQL)]
    names = {}
    for prefix, features in fits.items():
        steps, _ = least_squares_sql("encoded_rows", "", ["scrape_id", "price"], features, "price", _TRAIN_SQL, prefix)
        named += steps
        names[prefix] = [n for n, _ in steps]
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({s})" for n, s in named), names


_LINEAR_HEAD, _LINEAR_STEPS = _with_fits({"lin": LINEAR_FEATURES})
_LINEAR_LAST = _LINEAR_STEPS["lin"][-1]


@query(
    "linear_price",
    f"{_LINEAR_HEAD} SELECT scrape_id, CAST(price AS DOUBLE) AS actual, ROUND(price - t, 2) AS predicted FROM {_LINEAR_LAST} WHERE NOT tr",
)
def linear_price(spark, sf):
    """Ordinary least squares for the price: test predictions."""
    rows = mod.assemble(encoded_frame(spark, sf), LINEAR_FEATURES, "price", ["scrape_id"], centre=True)
    train, test = mod.hash_split(rows, "scrape_id")
    model = mod.fit(mod.linear(), train)
    return rounded(mod.predictions(model, test, ["scrape_id"]), 2)


def _coefficients_sql() -> str:
    """Coefficient of each feature from a fit in which it is swept last."""
    fits = {f"co{i}": [*(g for g in LINEAR_FEATURES if g != f), f] for i, f in enumerate(LINEAR_FEATURES)}
    head, names = _with_fits(fits)
    last = f"v{len(LINEAR_FEATURES)}"
    rows = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, SUM(t * {last}) / SUM({last} * {last}) AS importance FROM {names[f'co{i}'][-2]} WHERE tr"
        for i, f in enumerate(LINEAR_FEATURES)
    )
    return f"{head} SELECT feature, ROUND(importance, 2) AS importance FROM ({rows}) WHERE importance > 0"


@query("linear_coefficients", _coefficients_sql())
def linear_coefficients(spark, sf):
    rows = mod.assemble(encoded_frame(spark, sf), LINEAR_FEATURES, "price", ["scrape_id"], centre=True)
    train, _ = mod.hash_split(rows, "scrape_id")
    return mod.coefficient_table(mod.fit(mod.linear(), train), LINEAR_FEATURES, digits=2)


@query("gbt_selling_soon")
def gbt_selling_soon(spark, sf):
    """The share of soon sold listings from all other columns: test predictions of the slow learner."""
    rows, _ = _assembled(spark, sf, "sellingSoon")
    train, test = mod.hash_split(rows, "scrape_id")
    model = mod.fit(mod.boosted_trees(mod.DEMAND_BOOST), train)
    return rounded(mod.predictions(model, test, ["scrape_id"]))


@query("feature_importance")
def feature_importance(spark, sf):
    """Gain share of each listing feature for the price, above the floor."""
    rows, features = _assembled(spark, sf, "price", ("zestimate",))
    train, _ = mod.hash_split(rows, "scrape_id")
    model = mod.fit(mod.boosted_trees(mod.LISTING_BOOST), train)
    return rounded(mod.feature_importance(model, features), 6)


@query("model_leaderboard")
def model_leaderboard(spark, sf):
    rows = mod.assemble(encoded_frame(spark, sf), LINEAR_FEATURES, "price", ["scrape_id"], centre=True)
    train, test = mod.hash_split(rows, "scrape_id")
    return mod.leaderboard(train, test)


#: Penalty of the ridge model, in the learner's own units: it counts per training row, relative to the spread of the label.
RIDGE = 2e6


def _board_sql() -> str:
    """The ridge model is a fit with one more training row per feature, which holds that feature only."""
    p, names = len(LINEAR_FEATURES), ", ".join(LINEAR_FEATURES)
    spreads = ", ".join(f"STDDEV_POP({f}) FILTER ({_TRAIN_SQL}) AS s{i}" for i, f in enumerate(LINEAR_FEATURES))
    blank = ", ".join(f"CASE WHEN j = {i} THEN SQRT(n * {RIDGE} / sy) * s{i} ELSE 0 END AS {f}" for i, f in enumerate(LINEAR_FEATURES))
    centred = ", ".join(f"{f} - AVG({f}) OVER () AS {f}" for f in LINEAR_FEATURES)
    named = [
        ("encoded_rows", _ENCODED_SQL),
        ("spreads", f"SELECT COUNT(*) FILTER ({_TRAIN_SQL}) AS n, STDDEV_POP(price) FILTER ({_TRAIN_SQL}) AS sy, {spreads} FROM encoded_rows"),
        (
            "board_rows",
            f"SELECT learner, scrape_id, 1.0 AS one, {_TRAIN_SQL} AS seen, TRUE AS real, CAST(price AS DOUBLE) AS price, {names} "
            f"FROM (SELECT scrape_id, price, {centred} FROM encoded_rows), (VALUES ('linear'), ('ridge')) l(learner) "
            f"UNION ALL SELECT 'ridge', NULL, 0.0, TRUE, FALSE, 0.0, {blank} FROM spreads, range({p}) r(j)",
        ),
    ]
    steps, last = least_squares_sql("board_rows", "learner", ["real", "price"], LINEAR_FEATURES, "price", "seen", "bd", constant="one")
    named += steps
    body = f"""
    SELECT model, ROUND(mae, 2) AS mae, ROUND(rmse, 2) AS rmse, ROUND(r2, 6) AS r2 FROM (
      SELECT learner, AVG(ABS(t)) AS mae, SQRT(AVG(t * t)) AS rmse, 1 - AVG(t * t) / VAR_POP(price) AS r2 FROM {last} WHERE NOT tr AND real GROUP BY 1)
    JOIN (VALUES ('linear', 'linear'), ('generalized_linear', 'linear'), ('ridge', 'ridge')) m(model, learner) USING (learner)
    """
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in named) + body


@query("linear_leaderboard", _board_sql())
def linear_leaderboard(spark, sf):
    """The linear rows of the leaderboard: least squares, ridge and the gaussian model."""
    rows = mod.assemble(encoded_frame(spark, sf), LINEAR_FEATURES, "price", ["scrape_id"], centre=True)
    train, test = mod.hash_split(rows, "scrape_id")
    chosen = {"linear": mod.linear(), "ridge": mod.linear(RIDGE), "generalized_linear": mod.learners()["generalized_linear"]}
    board = mod.leaderboard(train, test, chosen)
    return board.select("model", F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2"))


_SPLIT_FEATURES = ALL_SIGNALS[1:]


@query(
    "boosted_root_split",
    f"""
    WITH r AS (
      SELECT avg_sales AS y, {", ".join(_SPLIT_FEATURES)} FROM signals
      WHERE avg_sales IS NOT NULL AND {" AND ".join(f"{f} IS NOT NULL" for f in _SPLIT_FEATURES)}
        AND CAST('0x' || substr(md5(CAST(month AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 20),
    long AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, y - (SELECT AVG(y) FROM r) AS y FROM r" for f in _SPLIT_FEATURES)}),
    v AS (SELECT feature, x, SUM(y) AS s, COUNT(*) AS n FROM long GROUP BY 1, 2),
    c AS (SELECT feature, x, LEAD(x) OVER w AS after, SUM(s) OVER w AS ls, SUM(n) OVER w AS ln, SUM(s) OVER a AS ts, SUM(n) OVER a AS tn
          FROM v WINDOW w AS (PARTITION BY feature ORDER BY x), a AS (PARTITION BY feature))
    SELECT ROUND((ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln)) / (SELECT SUM(y * y) FROM long WHERE feature = c.feature), 6) AS explained,
           CAST(LEAST(ln, tn - ln) AS BIGINT) AS smaller, CAST(GREATEST(ln, tn - ln) AS BIGINT) AS larger,
           ROUND(ABS(ls / ln - (ts - ls) / (tn - ln)), 4) AS apart
    FROM c WHERE after IS NOT NULL ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC LIMIT 1
    """,
)
def boosted_root_split(spark, sf):
    """Root of the first boosted tree of the price index, with every pair of neighbouring values as a possible split.

    Signals that part the months alike are equally good, so the parts are shown and not the signal.
    """
    stored = writers.stored(signals(spark, sf), shared_path(spark, "signals"))
    rows = mod.assemble(stored, _SPLIT_FEATURES, "avg_sales", ["month"])
    train, _ = mod.hash_split(rows, "month")
    learner = mod.boosted_trees(mod.MARKET_BOOST).setMaxIter(1).setMaxBins(1024)  # more bins than months
    shown = mod.root_split(mod.fit(learner, train), train)
    return shown.select(F.round("explained", 6).alias("explained"), "smaller", "larger", F.round("apart", 4).alias("apart"))


HISTORY_RUNS = ((), ("bedrooms",))


def _history_sql() -> str:
    fits = {f"hi{i}": [f for f in LINEAR_FEATURES if f not in out] for i, out in enumerate(HISTORY_RUNS)}
    head, names = _with_fits(fits)
    runs = " UNION ALL ".join(
        f"SELECT 'price' AS target, ROUND(1 - SUM(t * t) / (VAR_POP(price) * COUNT(*)), 6) AS r2, ROUND(AVG(t * t), 2) AS mse, "
        f"'{','.join(out)}' AS excluded_features, 'linear' AS model FROM {names[f'hi{i}'][-1]} WHERE NOT tr"
        for i, out in enumerate(HISTORY_RUNS)
    )
    return f"{head} {runs}"


@query("model_history", _history_sql())
def model_history(spark, sf):
    """Two runs appended to a log and read back."""
    path = shared_path(spark, "history")
    frame = encoded_frame(spark, sf)
    for excluded in HISTORY_RUNS:
        features = [f for f in LINEAR_FEATURES if f not in excluded]
        rows = mod.assemble(frame, features, "price", ["scrape_id"], centre=True)
        train, test = mod.hash_split(rows, "scrape_id")
        scored = mod.predictions(mod.fit(mod.linear(), train), test, [])
        run = mod.evaluate(scored, "actual", "predicted").select(
            F.lit("price").alias("target"), "r2", "mse", F.lit(",".join(excluded)).alias("excluded_features"),
            F.lit("linear").alias("model"),
        )
        mod.append_history(run, path)
    log = spark.read.parquet(path)
    return log.withColumns({"r2": F.round("r2", 6), "mse": F.round("mse", 2)})


@query("save_load_model", f"{_LINEAR_HEAD} SELECT scrape_id, ROUND(price - t, 2) AS predicted FROM {_LINEAR_LAST} WHERE NOT tr")
def save_load_model(spark, sf):
    """Predictions of a model that was saved and loaded again."""
    rows = mod.assemble(encoded_frame(spark, sf), LINEAR_FEATURES, "price", ["scrape_id"], centre=True)
    train, test = mod.hash_split(rows, "scrape_id")
    path = shared_path(spark, "model")
    mod.save_model(mod.fit(mod.linear(), train), path)
    return rounded(mod.predictions(mod.load_model(path), test, ["scrape_id"]).drop("actual"), 2)


_COOK_FEATURES = ["bedrooms", "bathrooms", "yearBuilt", "favoriteCount", "pageViewCount"]
_COOK_STEPS, _COOK_LAST = least_squares_sql("model_rows", "", ["scrape_id"], _COOK_FEATURES, "price", "TRUE", "ck")


@query(
    "cooks_distance",
    "WITH " + ", ".join(f"{n} AS MATERIALIZED ({s})" for n, s in _COOK_STEPS)
    + f""" SELECT scrape_id, ROUND(t, 2) AS residual, ROUND(h, 8) AS leverage,
    ROUND(t * t / (6 * (SUM(t * t) OVER () / (COUNT(*) OVER () - 6))) * h / ((1 - h) * (1 - h)), 8) AS cooks FROM {_COOK_LAST}""",
)
def cooks_distance(spark, sf):
    frame = model_frame(spark, sf).select("scrape_id", "price", *_COOK_FEATURES)
    stored = writers.stored(frame, shared_path(spark, "cooks-frame"))
    out = mod.cooks_distance(stored, "scrape_id", _COOK_FEATURES, "price")
    return out.select(
        "scrape_id", F.round("residual", 2).alias("residual"), F.round("leverage", 8).alias("leverage"),
        F.round("cooks", 8).alias("cooks"),
    )


@query("learning_validation_curves")
def learning_validation_curves(spark, sf):
    """Test metrics over training share, over regularisation, and while features are removed one by one."""
    frame = encoded_frame(spark, sf)
    rows = mod.assemble(frame, LINEAR_FEATURES, "price", ["scrape_id"], centre=True)
    train, test = mod.hash_split(rows, "scrape_id")
    curves = []

    def point(curve: str, x: float, learner, part: DataFrame, held: DataFrame) -> None:
        scored = mod.predictions(mod.fit(learner, part), held, [])
        curves.append(mod.evaluate(scored, "actual", "predicted").select(F.lit(curve).alias("curve"), F.lit(float(x)).alias("x"), "r2", "mae"))

    for share in SHARES:
        inside = mod.hash_bucket(F.concat(F.lit("share"), F.col("scrape_id").cast("string"))) < share
        point("learning", share, mod.linear(), train.where(inside), test)
    for reg in (0.0, 10.0, 1000.0):
        point("validation", reg, mod.linear(reg), train, test)
    left = list(LINEAR_FEATURES)
    while left:
        rows = mod.assemble(frame, left, "price", ["scrape_id"], centre=True)
        part, held = mod.hash_split(rows, "scrape_id")
        point("elimination", len(left), mod.linear(), part, held)
        forest = mod.fit(mod.learners()["decision_tree"], part)
        left.remove(min(zip(forest.featureImportances.toArray(), left))[1])
    return rounded(reduce(DataFrame.unionByName, curves))


SHARES = (20, 40, 60, 80, 100)
_SHARE_SQL = "CAST('0x' || substr(md5('share' || CAST(scrape_id AS VARCHAR)), 1, 8) AS BIGINT) % 100"


def _learning_sql() -> str:
    """One fit per share of the training rows; every fit is scored on the same test rows."""
    named, points = [("encoded_rows", _ENCODED_SQL)], []
    for share in SHARES:
        train = f"({_TRAIN_SQL}) AND {_SHARE_SQL} < {share}"
        steps, last = least_squares_sql("encoded_rows", "", ["scrape_id", "price"], LINEAR_FEATURES, "price", train, f"lc{share}_")
        named += steps
        enough = f"(SELECT COUNT(*) > {len(LINEAR_FEATURES) + 1} FROM encoded_rows WHERE {train})"
        points.append(
            f"SELECT {share} AS share, CASE WHEN {enough} THEN ROUND(1 - SUM(t * t) / (VAR_POP(price) * COUNT(*)), 6) END AS r2, "
            f"CASE WHEN {enough} THEN ROUND(AVG(ABS(t)), 2) END AS mae FROM {last} WHERE NOT ({_TRAIN_SQL})"
        )
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in named) + " " + " UNION ALL ".join(points)


@query("learning_curve", _learning_sql())
def learning_curve(spark, sf):
    """Test metrics of the linear model over the share of training rows it sees."""
    bucket = mod.hash_bucket(F.concat(F.lit("share"), F.col("scrape_id").cast("string")))
    curve = moment_models.learning_curve(encoded_frame(spark, sf), _held_out(), bucket, SHARES, LINEAR_FEATURES, "price")
    return curve.select("share", F.round("r2", 6).alias("r2"), F.round("mae", 2).alias("mae"))


def _held_out():
    return mod.hash_bucket(F.col("scrape_id")) < mod.TEST_SHARE


#: Folds and the penalties per training row of the models that are cross-validated.
FOLDS = 5
RIDGES = {"linear": 0.0, "ridge_0.01": 0.01, "ridge_0.1": 0.1, "ridge_1": 1.0}


def _folds_sql() -> str:
    """All folds of all learners in one chain: a penalty is a training row per feature with that feature only."""
    scaled = [f"{f} / STDDEV_POP({f}) OVER () AS {f}" for f in LINEAR_FEATURES]
    blank = ", ".join(f"CASE WHEN j = {i} THEN SQRT(penalty * n) ELSE 0 END AS {f}" for i, f in enumerate(LINEAR_FEATURES))
    names = ", ".join(LINEAR_FEATURES)
    learners = ", ".join(f"('{name}', {penalty})" for name, penalty in RIDGES.items())
    named = [
        ("encoded_rows", _ENCODED_SQL),
        ("scaled_rows", f"SELECT scrape_id, CAST(price AS DOUBLE) AS price, {', '.join(scaled)} FROM encoded_rows"),
        ("fold_rows", f"SELECT *, CAST('0x' || substr(md5('fold' || CAST(scrape_id AS VARCHAR)), 1, 8) AS BIGINT) % {FOLDS} AS own FROM scaled_rows"),
        ("contests", f"SELECT learner, penalty, fold FROM (VALUES {learners}) l(learner, penalty), (SELECT DISTINCT own AS fold FROM fold_rows)"),
        (
            "contest_rows",
            f"SELECT learner, fold, scrape_id, 1.0 AS one, own <> fold AS seen, TRUE AS real, price, {names} FROM contests, fold_rows "
            f"UNION ALL SELECT learner, fold, NULL, 0.0, TRUE, FALSE, 0.0, {blank} "
            f"FROM (SELECT learner, fold, penalty, (SELECT COUNT(*) FROM fold_rows WHERE own <> fold) AS n FROM contests WHERE penalty > 0), range({len(LINEAR_FEATURES)}) r(j)",
        ),
    ]
    steps, last = least_squares_sql("contest_rows", "learner, fold", ["real", "price"], LINEAR_FEATURES, "price", "seen", "cv", constant="one")
    named += steps
    body = f"""
    SELECT learner AS model, CAST(COUNT(*) AS INTEGER) AS folds, ROUND(AVG(rmse), 2) AS rmse, ROUND(AVG(r2), 6) AS r2, ROUND(STDDEV_POP(r2), 6) AS r2_spread,
           CAST(ROW_NUMBER() OVER (ORDER BY AVG(r2) DESC, learner) AS INTEGER) AS rank
    FROM (SELECT learner, fold, SQRT(AVG(t * t)) AS rmse, 1 - AVG(t * t) / VAR_POP(price) AS r2 FROM {last} WHERE NOT tr AND real GROUP BY ALL) GROUP BY learner
    """
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in named) + body


@query("cross_validated_leaderboard", _folds_sql())
def cross_validated_leaderboard(spark, sf):
    """Linear and ridge models of the listing price by their mean score over five folds."""
    fold = mod.hash_bucket(F.concat(F.lit("fold"), F.col("scrape_id").cast("string")), FOLDS)
    board = moment_models.cross_validated(encoded_frame(spark, sf), fold, LINEAR_FEATURES, "price", RIDGES)
    return board.select("model", "folds", F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("r2_spread", 6).alias("r2_spread"), "rank")


def _elimination_sql() -> str:
    """Every sweep is a step of its own over a table of matrix cells (i, j, v); the target is column p."""
    p = len(LINEAR_FEATURES)
    columns = [*LINEAR_FEATURES, "price"]
    stats = ", ".join(f"AVG({c}) FILTER (tr) OVER () AS m{i}, STDDEV_POP({c}) FILTER (tr) OVER () AS s{i}" for i, c in enumerate(columns))
    cells = " UNION ALL ".join(f"SELECT scrape_id, tr, {i} AS i, ({c} - m{i}) / s{i} AS z FROM marked" for i, c in enumerate(columns))
    named = [
        ("encoded_rows", _ENCODED_SQL),
        ("marked", f"SELECT *, {stats} FROM (SELECT *, {_TRAIN_SQL} AS tr FROM encoded_rows)"),
        ("cells", cells),
        ("moments", "SELECT a.tr, a.i, b.i AS j, SUM(a.z * b.z) AS v FROM cells a JOIN cells b ON a.scrape_id = b.scrape_id GROUP BY ALL"),
        ("full_0", "SELECT i, j, v FROM moments WHERE tr"),
    ]

    def swept(source: str, k: str, sign: int) -> str:
        return (
            f"SELECT a.i, a.j, CASE WHEN a.i = k.k AND a.j = k.k THEN -1 / d.v WHEN a.i = k.k OR a.j = k.k THEN {sign} * a.v / d.v ELSE a.v - r.v * c.v / d.v END AS v "
            f"FROM {source} a CROSS JOIN {k} k JOIN {source} d ON d.i = k.k AND d.j = k.k JOIN {source} r ON r.i = a.i AND r.j = k.k JOIN {source} c ON c.i = k.k AND c.j = a.j"
        )

    for k in range(p):
        named.append((f"full_{k + 1}", swept(f"full_{k}", f"(SELECT {k} AS k)", 1)))
    source, points = f"full_{p}", []
    for n in range(p, 0, -1):
        why = "NULL" if n == p else f"(SELECT {_case_name('k')} FROM out_{n + 1})"
        beta = f"(SELECT b.i, b.v FROM {source} b JOIN {source} d ON d.i = b.i AND d.j = b.i WHERE b.j = {p} AND b.i < {p} AND d.v < 0)"
        points.append(f"""
        SELECT {n} AS n_features, {why} AS removed, ROUND(1 - (SELECT v FROM {source} WHERE i = {p} AND j = {p}) / (SELECT v FROM full_0 WHERE i = {p} AND j = {p}), 6) AS train_r2,
               ROUND(1 - wrong / (SELECT SUM((z - (SELECT AVG(z) FROM cells WHERE i = {p} AND NOT tr)) ** 2) FROM cells WHERE i = {p} AND NOT tr), 6) AS test_r2,
               ROUND(SQRT(wrong / (SELECT COUNT(*) FROM cells WHERE i = {p} AND NOT tr)) * (SELECT ANY_VALUE(s{p}) FROM marked), 2) AS test_rmse
        FROM (SELECT SUM((y.z - coalesce(g.z, 0)) ** 2) AS wrong FROM (SELECT scrape_id, z FROM cells WHERE i = {p} AND NOT tr) y
              LEFT JOIN (SELECT c.scrape_id, SUM(c.z * b.v) AS z FROM cells c JOIN {beta} b USING (i) WHERE NOT c.tr GROUP BY 1) g USING (scrape_id))""")
        if n > 1:
            named.append((f"out_{n}", f"SELECT b.i AS k FROM {source} b JOIN {source} d ON d.i = b.i AND d.j = b.i WHERE b.j = {p} AND b.i < {p} AND d.v < 0 ORDER BY b.v * b.v / -d.v, b.i LIMIT 1"))
            named.append((f"left_{n}", swept(source, f"out_{n}", -1)))
            source = f"left_{n}"
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in named) + " " + " UNION ALL ".join(points)


def _case_name(k: str) -> str:
    return "CASE " + k + " " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(LINEAR_FEATURES)) + " END"


@query("elimination_path", _elimination_sql())
def elimination_path(spark, sf):
    """Backward elimination of the listing price's features, down to one, with the errors of every step."""
    path = moment_models.elimination_path(encoded_frame(spark, sf), _held_out(), LINEAR_FEATURES, "price")
    digits = {"train_r2": 6, "test_r2": 6, "test_rmse": 2}
    return path.withColumns({c: F.round(c, d) for c, d in digits.items()})


# --- with and without the extra signals ------------------------------------------------------

BASE = ["avg_sales"]
SIGNAL_FEATURES = ["avg_sales", "sales_count", *FEATURES]


def fund_months(spark: SparkSession, sf: str) -> DataFrame:
    """(ticker, month, y, last month's signals and price): monthly mean price of every ticker."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("ticker"))
    # Sums per part and month first: a part with many lines reaches the join as one row per month.
    day = F.col("l_shipdate").cast("date")
    per_part = lines.groupBy("l_partkey", cal.month_start(day).alias("month")).agg(
        F.sum("l_extendedprice").alias("total"), F.count("l_extendedprice").alias("n")
    )
    prices = per_part.join(brands, "l_partkey").groupBy("ticker", "month").agg(
        (F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("y")
    )
    both = prices.join(signals(spark, sf), "month")
    over = Window.partitionBy("ticker").orderBy("month")
    lagged = [F.lag(f).over(over).alias(f) for f in [*SIGNAL_FEATURES, "y"]]
    renamed = [c.alias("own") if i == len(lagged) - 1 else c for i, c in enumerate(lagged)]
    rows = both.select("ticker", "month", "y", F.row_number().over(over).alias("pos"), *renamed).where("pos > 1")
    cut = F.floor(F.count(F.lit(1)).over(Window.partitionBy("ticker")) * F.lit(0.8))
    return rows.withColumn("is_train", F.col("pos") - 1 <= cut)


define(
    "fund_months",
    """
    SELECT *, pos - 1 <= FLOOR(COUNT(*) OVER (PARTITION BY ticker) * 0.8) AS is_train FROM (
      SELECT ticker, month, y, ROW_NUMBER() OVER w AS pos, """
    + ", ".join(f"LAG({f}) OVER w AS {f}" for f in SIGNAL_FEATURES)
    + """, LAG(y) OVER w AS own
      FROM (SELECT p_brand AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, AVG(l_extendedprice) AS y
            FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) JOIN signals USING (month)
      WINDOW w AS (PARTITION BY ticker ORDER BY month))
    WHERE pos > 1
    """,
)
_CONTROL_STEPS, _CONTROL = least_squares_sql("fund_months", "ticker", ["month", "y"], [*BASE, "own"], "y", "is_train", "fc")
_TREAT_STEPS, _TREAT = least_squares_sql("fund_months", "ticker", ["month", "y"], [*SIGNAL_FEATURES, "own"], "y", "is_train", "ft")
_FUND_HEAD = "WITH " + ", ".join(f"{n} AS MATERIALIZED ({s})" for n, s in [*_CONTROL_STEPS, *_TREAT_STEPS])


def _errors_sql(source: str) -> str:
    return (
        f"SELECT ticker, AVG(ABS(t)) AS mae, AVG(2 * ABS(t) / (ABS(y) + ABS(y - t))) * 100 AS smape FROM {source} GROUP BY 1"
    )


def fund_errors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Metrics per ticker of the linear learner on base features and on all signals."""
    rows = writers.stored(fund_months(spark, sf), shared_path(spark, "fund-months"))
    out = []
    for features in ([*BASE, "own"], [*SIGNAL_FEATURES, "own"]):
        scored = mod.grouped_least_squares(rows, ["ticker"], features, "y", F.col("is_train"))
        out.append(mod.evaluate(scored, "y", "predicted", ["ticker"]))
    return out[0], out[1]


@query(
    "with_without_signals",
    f"""{_FUND_HEAD} SELECT ticker, ROUND(c.smape, 6) AS control, ROUND(t.smape, 6) AS treatment,
    ROUND(t.smape - c.smape, 6) AS difference FROM ({_errors_sql(_CONTROL)}) c JOIN ({_errors_sql(_TREAT)}) t USING (ticker)""",
)
def with_without_signals(spark, sf):
    """SMAPE per ticker without and with the extra signals, largest difference first."""
    control, treatment = fund_errors(spark, sf)
    both = control.select("ticker", F.col("smape").alias("control")).join(
        treatment.select("ticker", F.col("smape").alias("treatment")), "ticker"
    )
    table_ = rounded(both.withColumn("difference", F.col("treatment") - F.col("control")), 6)
    return table_.orderBy(F.desc("difference"), "ticker")


@query(
    "model_diff_summary",
    f"""{_FUND_HEAD} SELECT ROUND(AVG(c.mae), 4) AS control_mean, ROUND(AVG(t.mae), 4) AS treatment_mean,
    ROUND(AVG(c.mae - t.mae), 4) AS avg_difference, ROUND((AVG(c.mae) - AVG(t.mae)) / AVG(c.mae) * 100, 6) AS percent_difference
    FROM ({_errors_sql(_CONTROL)}) c JOIN ({_errors_sql(_TREAT)}) t USING (ticker)""",
)
def model_diff_summary(spark, sf):
    control, treatment = fund_errors(spark, sf)
    gain = aggregates.metric_gain(control, treatment, "ticker", "mae")
    return gain.select(
        F.round("control_mean", 4).alias("control_mean"),
        F.round("treatment_mean", 4).alias("treatment_mean"),
        F.round("avg_difference", 4).alias("avg_difference"),
        F.round("percent_difference", 6).alias("percent_difference"),
    )


@query(
    "prediction_frame",
    f"""{_FUND_HEAD} SELECT ticker, month, ROUND(m.y, 7) AS actual, ROUND(m.y - t, 3) AS predicted,
    CASE WHEN is_train THEN ROUND(m.y - t, 3) END AS train, CASE WHEN NOT is_train THEN ROUND(m.y - t, 3) END AS test
    FROM fund_months m LEFT JOIN {_TREAT} USING (ticker, month)""",
)
def prediction_frame(spark, sf):
    """Actual and predicted monthly prices, split into the train and the test part."""
    rows = fund_months(spark, sf)
    scored = mod.grouped_least_squares(rows, ["ticker"], [*SIGNAL_FEATURES, "own"], "y", F.col("is_train"))
    p = F.round("predicted", 3)
    return scored.select(
        "ticker", "month", F.round("y", 7).alias("actual"), p.alias("predicted"),
        F.when(F.col("is_train"), p).alias("train"), F.when(~F.col("is_train"), p).alias("test"),
    )
