"""Correlation tables, histograms, profiles and tract aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockpulse.functions.values import tract_bin


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL when either is constant."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    spread = F.stddev_samp(x) * F.stddev_samp(y)
    # A constant column can leave a rounding residue in the spread instead of an exact zero.
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varies, F.covar_samp(x, y) / F.nullif(spread, F.lit(0.0)))


def correlations(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One row with a map {pair name: correlation}, from a single pass and one small shuffle.

    Each row is unfolded into its pairs and reduced on the map side, so what is shuffled is one
    partial result per pair and task.
    """
    entries = [
        F.struct(F.lit(name).alias("pair"), x.cast("double").alias("x"), y.cast("double").alias("y"))
        for name, (x, y) in pairs.items()
    ]
    unfolded = df.select(F.inline(F.array(*entries)))
    each = unfolded.groupBy("pair").agg(safe_corr(F.col("x"), F.col("y")).alias("correlation"))
    return each.agg(F.map_from_entries(F.collect_list(F.struct("pair", "correlation"))).alias("corr"))


def found(name: str) -> Column:
    """Correlation of a named pair; NULL when there were no rows for it."""
    return F.try_element_at("corr", F.lit(name))


def _all_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return correlations(df, {f"{a}|{b}": (F.col(a), F.col(b)) for a, b in combinations(columns, 2)})


def _pair(a: str, b: str, columns: Sequence[str]) -> Column:
    if a == b:
        return F.lit(1.0)
    first, second = sorted((a, b), key=list(columns).index)
    return found(f"{first}|{second}")


def corr_matrix(df: DataFrame, columns: Sequence[str], label: str = "feature") -> DataFrame:
    """Symmetric matrix, one row per feature. The single result row is unfolded, nothing joined."""
    rows = [
        F.struct(F.lit(a).alias(label), *[_pair(a, b, columns).alias(b) for b in columns]) for a in columns
    ]
    return _all_pairs(df, columns).select(F.inline(F.array(*rows)))


def corr_table(df: DataFrame, primary: str, columns: Sequence[str]) -> DataFrame:
    """(col_name, correlation) of one column against every listed column."""
    one = correlations(df, {c: (F.col(primary), F.col(c)) for c in columns if c != primary})
    rows = [
        F.struct(
            F.lit(c).alias("col_name"), (F.lit(1.0) if c == primary else found(c)).alias("correlation")
        )
        for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))


def corr_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every ordered pair (primary, col_name, correlation)."""
    rows = [
        F.struct(F.lit(a).alias("primary_col"), F.lit(b).alias("col_name"), _pair(a, b, columns).alias("correlation"))
        for a in columns
        for b in columns
    ]
    return _all_pairs(df, columns).select(F.inline(F.array(*rows)))


def corr_to_target(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    table = corr_table(df, target, list(features))
    return table.select(F.col("col_name").alias("feature"), "correlation")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing count and share per column, one pass."""
    one = df.agg(F.count("*").alias("_n"), *[F.count(F.col(c)).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.col("_n") - F.col(c)).alias("missing"),
            ((F.col("_n") - F.col(c)) / F.nullif(F.col("_n"), F.lit(0))).alias("missing_share"),
        )
        for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 25) -> DataFrame:
    """Equal-width histogram per column: (feature, bin 1..bins, n). The maximum is in the last bin.

    Bounds come from one aggregate row used as a constant; the second pass counts per
    (feature, bin), at most `columns x bins` rows per partition after map-side combine.
    """
    bounds = df.agg(
        F.struct(
            *[F.min(F.col(c).cast("double")).alias(f"{c}_lo") for c in columns],
            *[F.max(F.col(c).cast("double")).alias(f"{c}_hi") for c in columns],
        )
    ).scalar()

    def bucket(c: str) -> Column:
        lo, hi = F.col(f"_bounds.{c}_lo"), F.col(f"_bounds.{c}_hi")
        raw = F.width_bucket(F.col(c).cast("double"), lo, hi, F.lit(bins))
        return F.when(F.col(c).isNotNull(), F.when(lo == hi, F.lit(1)).otherwise(F.least(raw, F.lit(bins))))

    entries = F.array(
        *[F.struct(F.lit(c).alias("feature"), bucket(c).cast("bigint").alias("bin")) for c in columns]
    )
    bounded = df.select(*columns, bounds.alias("_bounds"))
    return bounded.select(F.inline(entries)).where("bin IS NOT NULL").groupBy("feature", "bin").agg(F.count("*").alias("n"))


def tract_counts(rows: DataFrame, tract: str, period: Column, period_name: str, count_as: str = "n") -> DataFrame:
    """Non-null tract count per (period, tract bin); rows without a key are left out."""
    keyed = rows.select(period.alias(period_name), tract_bin(F.col(tract)).alias("tract_grp"), F.col(tract))
    keyed = keyed.where(F.col(period_name).isNotNull() & F.col("tract_grp").isNotNull())
    return keyed.groupBy(period_name, "tract_grp").agg(F.count(tract).alias(count_as))


def tract_mean(rows: DataFrame, tract: str, period: Column, period_name: str, value: str, mean_as: str) -> DataFrame:
    keyed = rows.select(period.alias(period_name), tract_bin(F.col(tract)).alias("tract_grp"), F.col(value))
    keyed = keyed.where(F.col(period_name).isNotNull() & F.col("tract_grp").isNotNull())
    return keyed.groupBy(period_name, "tract_grp").agg(F.avg(value).alias(mean_as))


def top_groups(df: DataFrame, key: str, n: int = 10, count_as: str = "n") -> DataFrame:
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(count_as))
    return counts.orderBy(F.desc(count_as), F.asc(key)).limit(n)


def metric_gain(control: DataFrame, treatment: DataFrame, key: str, metric: str) -> DataFrame:
    """Mean of a metric without and with extra features, absolute and percent difference."""
    paired = control.select(key, F.col(metric).alias("control")).join(
        treatment.select(key, F.col(metric).alias("treatment")), key
    )
    c, t = F.avg("control"), F.avg("treatment")
    return paired.agg(
        c.alias("control_mean"),
        t.alias("treatment_mean"),
        F.avg(F.col("control") - F.col("treatment")).alias("avg_difference"),
        ((c - t) / F.nullif(c, F.lit(0.0)) * 100).alias("percent_difference"),
    )


def rename_and_order(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select the given columns in the given order under new names: {old: new}."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])
