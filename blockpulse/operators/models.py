"""Feature frames, price models and their evaluation on pyspark.ml."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    FMRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockpulse.functions import numeric
from blockpulse.operators.moments import gram
from blockpulse.session import ensure_checkpoint_dir

SEED = 42
TEST_SHARE = 20


@dataclass(frozen=True)
class BoostParams:
    trees: int
    depth: int
    rate: float


# Boosted-tree settings of the market, listing and demand models.
MARKET_BOOST = BoostParams(100, 5, 0.1)
LISTING_BOOST = BoostParams(200, 5, 0.1)
DEMAND_BOOST = BoostParams(600, 5, 0.01)
MIN_IMPORTANCE = 0.002


# --- preparation -----------------------------------------------------------------------------


def selected_features(flags: Mapping[str, bool], target: str) -> tuple[list[str], list[str]]:
    """(included, excluded) feature names; the target is never a feature."""
    included = [f for f, on in flags.items() if on and f != target]
    return included, [f for f, on in flags.items() if not on]


def assemble(df: DataFrame, features: Sequence[str], target: str, keep: Sequence[str] = (), centre: bool = False) -> DataFrame:
    """(keep, features vector, label); rows with a missing value are dropped.

    `centre` moves every feature to mean 0, from one pass that returns one row. A linear model with an
    intercept has the same coefficients and predictions, and large offsets (coordinates, years) no
    longer cancel in its sums of products.
    """
    numbers = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features], F.col(target).cast("double").alias("label"))
    complete = numbers.dropna(subset=[*features, "label"])
    if centre:
        means = complete.agg(*[F.avg(f).alias(f) for f in features]).first()
        complete = complete.withColumns({f: F.col(f) - F.lit(means[f] or 0.0) for f in features})
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(complete).select(*keep, "features", "label")


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 of a key, the same on every run and engine."""
    digest = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") % buckets


def hash_split(df: DataFrame, key: str, test_share: int = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the hash of a key: no sampling state, nothing shuffled."""
    bucket = hash_bucket(F.col(key))
    return df.where(bucket >= test_share), df.where(bucket < test_share)


def replace_zero_with_mean(df: DataFrame, column: str) -> DataFrame:
    """0 becomes the column mean; the mean counts the zeros."""
    mean = df.agg(F.avg(column).alias("m")).scalar()
    return df.withColumn(column, F.when(F.col(column) == 0, mean).otherwise(F.col(column)))


@contextmanager
def kept(df: DataFrame):
    """Hold a training frame in memory and on disk while it is used more than once."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


# --- learners --------------------------------------------------------------------------------


def boosted_trees(params: BoostParams) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features", labelCol="label", maxIter=params.trees, maxDepth=params.depth, stepSize=params.rate,
        seed=SEED, checkpointInterval=10,
    )


def linear(reg: float = 0.0) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol="label", regParam=reg)


def fit(learner, train: DataFrame) -> Model:
    ensure_checkpoint_dir(train.sparkSession)
    with kept(train) as rows:
        return learner.fit(rows)


def learners() -> dict[str, object]:
    """The regressors that are compared on a leaderboard."""
    common = {"featuresCol": "features", "labelCol": "label"}
    return {
        "linear": linear(),
        "decision_tree": DecisionTreeRegressor(maxDepth=5, seed=SEED, **common),
        "random_forest": RandomForestRegressor(numTrees=100, maxDepth=5, seed=SEED, **common),
        "boosted_trees": GBTRegressor(maxIter=100, maxDepth=5, stepSize=0.1, seed=SEED, checkpointInterval=10, **common),
        "generalized_linear": GeneralizedLinearRegression(family="gaussian", **common),
        "factorization_machine": FMRegressor(factorSize=4, maxIter=50, stepSize=0.05, seed=SEED, **common),
    }


# --- evaluation ------------------------------------------------------------------------------


def regression_metrics(actual: Column, predicted: Column) -> dict[str, Column]:
    """Aggregate expressions over rows where both are present."""
    both = actual.isNotNull() & predicted.isNotNull()
    y, p = F.when(both, actual.cast("double")), F.when(both, predicted.cast("double"))
    error = y - p
    squared = F.avg(error * error)
    positive = (y > -1) & (p > -1)
    log_gap = F.when(positive, F.log1p(p) - F.log1p(y))
    return {
        "mae": F.avg(F.abs(error)),
        "mse": squared,
        "rmse": F.sqrt(squared),
        "r2": 1 - F.sum(error * error) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0)),
        "mape": F.avg(F.abs(error / F.nullif(y, F.lit(0.0)))) * 100,
        "smape": F.avg(2 * F.abs(error) / F.nullif(F.abs(y) + F.abs(p), F.lit(0.0))) * 100,
        "rmsle": F.sqrt(F.avg(log_gap * log_gap)),
    }


def evaluate(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    metrics = [c.alias(n) for n, c in regression_metrics(F.col(actual), F.col(predicted)).items()]
    return df.groupBy(*by).agg(*metrics) if by else df.agg(*metrics)


def predictions(model: Model, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(rows).select(*keep, F.col("label").alias("actual"), F.col("prediction").alias("predicted"))


def feature_importance(model: Model, features: Sequence[str], floor: float = MIN_IMPORTANCE) -> DataFrame:
    """(feature, importance) above the floor, most important first."""
    from pyspark.sql import SparkSession

    pairs = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray()) if v > floor]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def coefficient_table(model: Model, features: Sequence[str], digits: int = 3) -> DataFrame:
    """Positive coefficients rounded to some digits, largest first."""
    from pyspark.sql import SparkSession

    pairs = [(f, float(v)) for f, v in zip(features, model.coefficients.toArray())]
    spark = SparkSession.getActiveSession()
    table = spark.createDataFrame(pairs, "feature string, importance double").where("importance > 0")
    return table.select("feature", F.round("importance", digits).alias("importance")).orderBy(F.desc("importance"), "feature")


def root_split(model: Model, train: DataFrame) -> DataFrame:
    """(explained, smaller, larger, apart) of the first tree's root: the share of the label's variance that its split
    explains, the training rows on both sides, and how far their mean labels are apart."""
    root = model.trees[0]._java_obj.rootNode()
    explained = root.gain() / root.impurity() if root.impurity() else 0.0
    left = vector_to_array("features")[root.split().featureIndex()] <= root.split().threshold()
    n, n_left, y_left, y = F.count("*"), F.count(F.when(left, 1)), F.avg(F.when(left, F.col("label"))), F.avg(F.when(~left, F.col("label")))
    return train.agg(F.least(n_left, n - n_left).alias("smaller"), F.greatest(n_left, n - n_left).alias("larger"), F.abs(y_left - y).alias("apart")).select(
        F.lit(float(explained)).alias("explained"), "smaller", "larger", "apart"
    )


def leaderboard(train: DataFrame, test: DataFrame, models: Mapping[str, object] | None = None) -> DataFrame:
    """(model, metrics, fit_seconds) for each learner, best R2 first.

    The rows stay in Spark; only one metric row per model reaches the driver.
    """
    spark = train.sparkSession
    rows = []
    with kept(train) as fitted_on, kept(test) as scored_on:
        for name, learner in (models or learners()).items():
            began = time.perf_counter()
            model = learner.fit(fitted_on)
            seconds = time.perf_counter() - began
            scored = predictions(model, scored_on, [])
            metrics = evaluate(scored, "actual", "predicted").first().asDict()
            rows.append((name, *[metrics[m] for m in METRIC_NAMES], seconds))
    schema = "model string, " + ", ".join(f"{m} double" for m in METRIC_NAMES) + ", fit_seconds double"
    return spark.createDataFrame(rows, schema).orderBy(F.desc("r2"), "model")


METRIC_NAMES = ["mae", "mse", "rmse", "r2", "mape", "smape", "rmsle"]


# --- least squares on moments, many targets at once -------------------------------------------


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _least_squares(grams: pd.Series) -> pd.Series:
    out = []
    for g in grams:
        flat = np.asarray(g, dtype=float)
        size = int(round(len(flat) ** 0.5))
        _, beta = numeric.ssr_from_gram(flat.reshape(size, size), list(range(size - 1)), size - 1)
        out.append([None if b != b else float(b) for b in beta])
    return pd.Series(out)


def grouped_least_squares(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, train: Column) -> DataFrame:
    """Every row with `predicted`, from one linear fit per group on the rows marked `train`.

    Products are summed by Spark for all groups in one aggregation. A row with a missing feature, and
    a row of a group without a fit, has a NULL prediction.
    """
    regressors = F.array(F.lit(1.0), *[F.col(f).cast("double") for f in features])
    rows = df.withColumns({"_x": regressors, "_train": train})
    known = F.forall("_x", lambda v: v.isNotNull())
    fitted = rows.where(F.col("_train") & known & F.col(target).isNotNull())
    vectors = fitted.withColumn("_v", F.concat("_x", F.array(F.col(target).cast("double"))))
    betas = gram(vectors, keys, "_v").select(*keys, _least_squares("gram").alias("_beta"))
    products = F.zip_with("_x", "_beta", lambda x, b: x * b)
    predicted = F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)
    return rows.join(betas, list(keys), "left").withColumn("predicted", predicted).drop("_x", "_beta", "_train")


def cooks_distance(df: DataFrame, key: str, features: Sequence[str], target: str) -> DataFrame:
    """(key, residual, leverage, cooks) of an ordinary least-squares fit.

    Only the p x p moment matrix reaches the driver; leverage is a column expression per row. The
    distance of a row that alone decides its fitted value (leverage 1) is not defined: NULL.
    """
    p = len(features) + 1
    vector = F.array(F.lit(1.0), *[F.col(f).cast("double") for f in features], F.col(target).cast("double"))
    rows = df.select(key, vector.alias("v")).where(F.forall("v", lambda x: x.isNotNull()))
    total = gram(rows.withColumn("one", F.lit(1)), ["one"], "v").first()
    g = np.asarray(total["gram"]).reshape(p + 1, p + 1)
    ssr, beta = numeric.ssr_from_gram(g, list(range(p)), p)
    scale = np.sqrt(np.diag(g)[:p])
    inverse = np.linalg.inv(g[:p, :p] / np.outer(scale, scale)) / np.outer(scale, scale)
    variance = ssr / (total["n"] - p) if total["n"] > p else 0.0

    def dot(weights: np.ndarray) -> Column:
        return sum((F.lit(float(w)) * F.col("v")[i] for i, w in enumerate(weights)), F.lit(0.0))

    leverage = sum((F.col("v")[i] * dot(inverse[i]) for i in range(p)), F.lit(0.0))
    residual = F.col("v")[p] - dot(beta)
    out = rows.select(key, residual.alias("residual"), leverage.alias("leverage"))
    e, h = F.col("residual"), F.col("leverage")
    free = F.when(1 - h > 1e-9, (1 - h) * (1 - h))
    return out.withColumn("cooks", e * e / F.nullif(F.lit(p * variance), F.lit(0.0)) * h / free)


# --- persistence -----------------------------------------------------------------------------


def save_model(model: Model, path: str) -> None:
    PipelineModel(stages=[model]).write().overwrite().save(path)


def load_model(path: str) -> Model:
    return PipelineModel.load(path).stages[0]


def append_history(df: DataFrame, path: str) -> None:
    """Add model runs to a log."""
    df.write.mode("append").parquet(path)
