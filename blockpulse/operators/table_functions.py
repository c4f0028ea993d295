"""Table functions that SQL users can call, next to other tables and with a column as argument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from blockpulse.session import shared_path
from blockpulse.sources.writers import stored


def _name(text: str) -> str:
    return "`" + text.replace("`", "``") + "`"


def _text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_correlations(frame: DataFrame, columns: Sequence[str], name: str = "calculate_corr") -> None:
    """Create the temporary SQL function `name(primary_col)`: (col_name, correlation) with each of `columns`.

    The frame is stored once and read by every call. A call picks its pairs by an equality, so a lateral
    join that passes a column of names is planned as one aggregation over one scan, however many
    names there are. A name that is no column gives no rows, a constant column NULL, a column with itself 1.
    """
    spark = frame.sparkSession
    view = f"{name}_frame"
    numbers = frame.selectExpr(*[f"CAST({_name(c)} AS DOUBLE) AS {_name(c)}" for c in columns])
    stored(numbers, shared_path(spark, view)).createOrReplaceTempView(_name(view))
    pairs = ", ".join(f"named_struct('primary_name', {_text(a)}, 'col_name', {_text(b)}, 'p', {_name(a)}, 'v', {_name(b)})" for a in columns for b in columns)
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {_name(name)}(primary_col STRING) RETURNS TABLE(col_name STRING, correlation DOUBLE)
        RETURN SELECT col_name, CASE WHEN max(same) THEN 1.0D
                   WHEN min(p) < max(p) AND min(v) < max(v) THEN covar_samp(p, v) / nullif(stddev_samp(p) * stddev_samp(v), 0.0D) END
               FROM (SELECT primary_name, col_name, same, CASE WHEN v IS NOT NULL THEN p END AS p, CASE WHEN p IS NOT NULL THEN v END AS v
                     FROM (SELECT t.primary_name, t.col_name, t.p, t.v, t.primary_name = t.col_name AS same FROM {_name(view)} LATERAL VIEW inline(array({pairs})) t))
               WHERE primary_name = primary_col GROUP BY col_name
        """
    )


def correlation_matrix_sql(columns: Sequence[str], name: str = "calculate_corr") -> str:
    """One statement that calls the function for every column and lays the answers side by side."""
    names = ", ".join(f"({_text(c)})" for c in columns)
    cells = ", ".join(f"max(CASE WHEN c.col_name = {_text(b)} THEN c.correlation END) AS {_name(b)}" for b in columns)
    return f"SELECT f.feature, {cells} FROM VALUES {names} AS f(feature), LATERAL {_name(name)}(f.feature) AS c GROUP BY f.feature"
