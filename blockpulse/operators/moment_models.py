"""Linear models from sums of products: cross-validation, elimination and learning curves in one pass.

Rows are read once for their means and once for their products, summed by Spark per fold. What a model
needs of its training rows is the total less its own fold, and its errors on the fold follow from the
fold's products, so no row is read again however many learners, folds or subsets are compared. Only the
moments, a square matrix per fold, reach a Python worker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockpulse.operators.moments import gram

#: A pivot below this share of its column is a column that the others already give.
SINGULAR = 1e-10


@dataclass
class Moments:
    """Products of [1, features, target] over some rows."""

    products: np.ndarray

    @property
    def n(self) -> float:
        return self.products[0, 0]

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.products + other.products)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.products - other.products)

    def means(self) -> np.ndarray:
        return self.products[0, 1:] / self.n

    def about(self, centre: np.ndarray) -> np.ndarray:
        """Products of [features, target] about a centre."""
        sums, inner = self.products[0, 1:], self.products[1:, 1:]
        return inner - np.outer(sums, centre) - np.outer(centre, sums) + self.n * np.outer(centre, centre)

    def errors(self, centre: np.ndarray, beta: np.ndarray) -> tuple[float, float]:
        """(sum of squared errors, sum of squares about the mean) of predictions centre + beta * (x - centre)."""
        own = self.about(centre)
        weights = np.append(-beta, 1.0)
        spread = self.about(self.means())[-1, -1]
        return max(float(weights @ own @ weights), 0.0), float(spread)


def sweep(a: np.ndarray, k: int, back: bool = False) -> np.ndarray:
    """The matrix after column `k` is swept into the model, or out of it (`back`).

    Columns in the model hold the negative inverse of their products, the last column their
    coefficients, and its corner the sum of squared residuals.
    """
    pivot, row = a[k, k], a[k].copy()
    out = a - np.outer(row, row) / pivot
    out[k], out[:, k] = row / pivot, row / pivot
    if back:
        out[k], out[:, k] = -out[k], -out[:, k]
    out[k, k] = -1 / pivot
    return out


def fitted(train: Moments, ridge: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray] | None:
    """(centre, beta) of the least squares with an unpenalised constant; None if the rows don't determine it."""
    centre = train.means()
    inner = train.about(centre)
    p = len(inner) - 1
    a = inner[:p, :p] + np.diag(np.broadcast_to(np.asarray(ridge, dtype=float), p))
    scale = np.sqrt(np.clip(np.diag(a), 0, None))
    if train.n <= p + 1 and not np.any(ridge) or np.any(scale <= 0):
        return None
    unit = a / np.outer(scale, scale)
    if np.linalg.cond(unit) > 1 / SINGULAR:
        return None
    return centre, np.linalg.solve(unit, inner[:p, p] / scale) / scale


def moments_by(df: DataFrame, group: Column, features: Sequence[str], target: str) -> DataFrame:
    """(fold, gram): products of [1, features, target] per group; rows with a missing value are left out.

    Every column is moved to mean 0 first and divided by its spread, from one pass that returns one row,
    so that large offsets do not cancel. `means` and `spreads` come with every row.
    """
    names = [*features, target]
    rows = _complete(df, names).select(group.cast("int").alias("fold"), "_v")
    at = [F.col("_v")[i] for i in range(len(names))]
    stats = rows.agg(F.array(*[F.avg(x) for x in at]).alias("m"), F.array(*[F.stddev_pop(x) for x in at]).alias("s")).first()
    means, spreads = [m or 0.0 for m in stats.m], [s or 1.0 for s in stats.s]
    scaled = [(x - F.lit(m)) / F.lit(s) for x, m, s in zip(at, means, spreads)]
    vectors = rows.select("fold", F.array(F.lit(1.0), *scaled).alias("v"))
    numbers_of = {"means": means, "spreads": spreads}
    return gram(vectors, ["fold"], "v").select("fold", "gram", *[F.array(*[F.lit(x) for x in v]).alias(name) for name, v in numbers_of.items()])


def _complete(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df` with the columns as one array of doubles, `_v`, without rows that miss one."""
    return df.withColumn("_v", F.array(*[F.col(c).cast("double") for c in names])).where(~F.exists("_v", lambda x: x.isNull()))


def _matrices(rows: pd.DataFrame) -> dict[int, Moments]:
    size = int(round(len(rows["gram"].iloc[0]) ** 0.5))
    return {int(f): Moments(np.array(g, dtype=float).reshape(size, size)) for f, g in zip(rows["fold"], rows["gram"])}


def cross_validated(df: DataFrame, fold: Column, features: Sequence[str], target: str, ridges: Mapping[str, float]) -> DataFrame:
    """(model, folds, rmse, r2, r2_spread, rank): linear models by name and ridge penalty, scored on every fold, best first.

    A penalty counts per training row and for features in units of their spread over all rows. Each
    score is the mean over the folds; folds whose training rows don't determine a model are left out
    of its row, and a model without any has NULLs.
    """
    found = moments_by(df, fold, features, target)

    def scored(rows: pd.DataFrame) -> pd.DataFrame:
        folds, unit = _matrices(rows), rows["spreads"].iloc[0][-1]
        total = Moments(sum(m.products for m in folds.values()))
        out = []
        for name, penalty in ridges.items():
            marks = []
            for held in folds.values():
                train = total - held
                fit = fitted(train, penalty * train.n) if train.n > 0.5 else None
                if fit is not None:
                    wrong, spread = held.errors(*fit)
                    marks.append((np.sqrt(wrong / held.n) * unit, 1 - wrong / spread if spread > 0 else np.nan))
            rmse, r2 = np.array(marks).T if marks else (np.array([np.nan]),) * 2
            out.append((name, len(marks), rmse.mean(), r2.mean(), r2.std()))
        table = pd.DataFrame(out, columns=["model", "folds", "rmse", "r2", "r2_spread"])
        order = sorted(range(len(table)), key=lambda i: (-table["r2"][i] if table["r2"][i] == table["r2"][i] else np.inf, table["model"][i]))
        table["rank"] = [order.index(i) + 1 for i in range(len(table))]
        return table

    # One row per fold.
    schema = "model string, folds int, rmse double, r2 double, r2_spread double, rank int"
    return _without_nan(found.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(scored, schema))


def elimination_path(df: DataFrame, held_out: Column, features: Sequence[str], target: str) -> DataFrame:
    """(n_features, removed, train_r2, test_r2, test_rmse): backward elimination from all features down to one.

    `removed` is the feature whose loss leads to this row: the one that raises the squared error least
    (the first of equals); features that the others already give go first. One sweep of the products
    takes a feature out, so no model is fitted anew.
    """
    names = list(features)
    found = moments_by(df, held_out.cast("int"), names, target)

    def path(rows: pd.DataFrame) -> pd.DataFrame:
        parts, unit = _matrices(rows), rows["spreads"].iloc[0][-1]
        train, test, p = parts.get(0), parts.get(1), len(names)
        if train is None:
            return pd.DataFrame([], columns=["n_features", "removed", "train_r2", "test_r2", "test_rmse"])
        centre = train.means()
        a = train.about(centre)
        scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
        whole, a = a[p, p], a / np.outer(scale, scale)
        inside = []
        for k in range(p):
            if a[k, k] > SINGULAR:
                a = sweep(a, k)
                inside.append(k)
        left, removed, out = list(range(p)), None, []
        while left:
            beta = np.array([a[k, p] if k in inside else 0.0 for k in range(p)]) * scale[p] / scale[:p]
            wrong, spread = test.errors(centre, beta) if test is not None else (np.nan, np.nan)
            rmse = np.sqrt(wrong / test.n) * unit if test is not None else np.nan
            out.append((len(left), removed, 1 - max(a[p, p], 0.0) * scale[p] ** 2 / whole if whole > 0 else np.nan, 1 - wrong / spread if spread > 0 else np.nan, rmse))
            worst = min(left, key=lambda k: (a[k, p] ** 2 / -a[k, k] if k in inside else -1.0, k))
            if worst in inside:
                a = sweep(a, worst, back=True)
                inside.remove(worst)
            left.remove(worst)
            removed = names[worst]
        return pd.DataFrame(out, columns=["n_features", "removed", "train_r2", "test_r2", "test_rmse"])

    # One row for the training rows and one for the others.
    schema = "n_features int, removed string, train_r2 double, test_r2 double, test_rmse double"
    return _without_nan(found.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(path, schema))


def learning_curve(df: DataFrame, held_out: Column, bucket: Column, shares: Sequence[int], features: Sequence[str], target: str) -> DataFrame:
    """(share, rows, r2, mae) on the held-out rows, for models that saw the training rows of bucket < share.

    A share with no more rows than coefficients, or whose rows don't determine them, has NULL figures.
    The products of each step between two shares are summed once; one more pass scores all models.
    """
    shares = sorted(shares)
    step = F.lit(len(shares))
    for i, share in reversed(list(enumerate(shares))):
        step = F.when(bucket < share, i).otherwise(step)
    found = moments_by(df.where(~held_out), step, features, target)

    def fits(rows: pd.DataFrame) -> pd.DataFrame:
        steps, means, spreads = _matrices(rows), np.array(rows["means"].iloc[0]), np.array(rows["spreads"].iloc[0])
        out, total = [], None
        for i, share in enumerate(shares):
            if i in steps:
                total = steps[i] if total is None else total + steps[i]
            fit = fitted(total) if total is not None else None
            if fit is None:
                out.append((share, int(round(total.n)) if total is not None else 0, None))
                continue
            centre, beta = fit
            slopes = beta * spreads[-1] / spreads[:-1]
            at = means + centre * spreads
            out.append((share, int(round(total.n)), [at[-1] - slopes @ at[:-1], *slopes]))
        return pd.DataFrame(out, columns=["share", "rows", "beta"])

    # One row per share.
    models = found.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fits, "share int, rows long, beta array<double>")
    models = {r.share: r for r in models.collect()}
    test = _complete(df.where(held_out), [*features, target])
    columns, y, scores = F.concat(F.array(F.lit(1.0)), F.slice("_v", 1, len(features))), F.element_at("_v", -1), {}
    for share in shares:
        known = models.get(share)
        if known is not None and known.beta is not None:
            guess = F.aggregate(F.zip_with(columns, F.array(*[F.lit(b) for b in known.beta]), lambda x, b: x * b), F.lit(0.0), lambda s, v: s + v)
            scores[share] = y - guess
    wrong = [F.struct(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae")).alias(str(share)) for share, e in scores.items()]
    spread = F.var_pop(y)
    if not wrong:
        wrong = [F.count("*").alias("none")]
    one = test.agg(spread.alias("spread"), *wrong)

    def shown(share: int) -> Column:
        rows = models[share].rows if share in models else 0
        r2, mae = (1 - F.col(f"{share}.mse") / F.nullif(F.col("spread"), F.lit(0.0)), F.col(f"{share}.mae")) if share in scores else (F.lit(None).cast("double"),) * 2
        return F.struct(F.lit(share).alias("share"), F.lit(rows).cast("long").alias("rows"), r2.alias("r2"), mae.alias("mae"))

    return one.select(F.inline(F.array(*[shown(s) for s in shares])))


def _without_nan(df: DataFrame) -> DataFrame:
    return df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
