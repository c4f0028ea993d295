"""SQL text for regression tests: sums of squares by successive orthogonalisation.

A regressor is swept out of every later column with window sums, so the remaining length of the
target is the residual sum of squares. This is a different route from the solver in the library.
"""

from __future__ import annotations


def _sweep(previous: str, keys: str, columns: list[str], pivot: str, carry: list[str]) -> str:
    part = f"(PARTITION BY {keys})"
    out = [
        f"{c} - COALESCE(SUM({c} * {pivot}) OVER {part} / NULLIF(SUM({pivot} * {pivot}) OVER {part}, 0), 0) * {pivot} AS {c}"
        for c in columns
    ]
    return f"SELECT {', '.join([keys, *carry, *out])} FROM {previous}"


def granger_ctes(pairs: str, keys: str, lag: int, prefix: str) -> tuple[list[tuple[str, str]], str]:
    """Named steps for one lag, and the final select (keys, lag, n, f) over them."""
    window = f"(PARTITION BY {keys} ORDER BY ts)"
    regressors = ["1.0 AS v0"]
    regressors += [f"LAG(y, {k}) OVER {window} AS v{k}" for k in range(1, lag + 1)]
    regressors += [f"LAG(x, {k}) OVER {window} AS v{lag + k}" for k in range(1, lag + 1)]
    steps = [
        (
            f"{prefix}_0",
            f"SELECT {keys}, TRUE AS ok, {', '.join(regressors)}, y AS t FROM {pairs} "
            f"QUALIFY ROW_NUMBER() OVER {window} > {lag}",
        )
    ]
    total = 2 * lag + 1
    # The series are standardised, so a regressor of which nothing is left depends on those before it.
    carry: list[str] = []
    for j in range(total):
        rest = [f"v{k}" for k in range(j + 1, total)] + ["t"]
        left = f"ok AND SUM(v{j} * v{j}) OVER (PARTITION BY {keys}) > 1e-12 AS ok"
        sql = _sweep(f"{prefix}_{j}", keys, rest, f"v{j}", [left, *carry])
        if j == lag:
            sql = f"SELECT *, t AS r FROM ({sql})"
            carry = ["r"]
        steps.append((f"{prefix}_{j + 1}", sql))
    final = (
        f"SELECT {keys}, {lag} AS lag, COUNT(*) AS n, COUNT(*) - {total} AS d2, "
        f"CASE WHEN COUNT(*) > {total} AND BOOL_AND(ok) THEN (SUM(r * r) - SUM(t * t)) / {lag} / NULLIF(SUM(t * t) / (COUNT(*) - {total}), 0) "
        f"END AS f FROM {prefix}_{total} GROUP BY ALL"
    )
    return steps, final


def f_tail(source: str, points: int = 2000) -> str:
    """`source` (.., lag, d2, f) with p: the upper tail of F(lag, d2).

    The beta integral is taken over an angle, where its integrand sin^(d2-1) cos^(lag-1) is smooth,
    by Simpson's rule.
    """
    angle = "asin(sqrt(d2 / (d2 + lag * GREATEST(f, 0))))"
    return f"""
    SELECT s.* EXCLUDE (h), CASE WHEN f IS NULL THEN NULL ELSE
        2 * exp(lgamma((lag + d2) / 2.0) - lgamma(lag / 2.0) - lgamma(d2 / 2.0)) * q.area * h / 3 END AS p
    FROM (SELECT *, {angle} / {points} AS h FROM (SELECT * REPLACE (CASE WHEN d2 > 0 THEN f END AS f,
          GREATEST(d2, 1) AS d2) FROM ({source}))) s,
    LATERAL (SELECT SUM((CASE WHEN i IN (0, {points}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                        * pow(sin(i * h), d2 - 1) * pow(cos(i * h), lag - 1)) AS area
             FROM range(0, {points} + 1) g(i)) q
    """


def granger_sql(pairs: str, keys: str, lags: list[int], prefix: str) -> tuple[list[tuple[str, str]], str]:
    """All named steps, and a statement giving (keys, lag, n, d2, f, p)."""
    steps: list[tuple[str, str]] = []
    finals = []
    for lag in lags:
        ctes, final = granger_ctes(pairs, keys, lag, f"{prefix}{lag}")
        steps += ctes
        finals.append(final)
    steps.append((f"{prefix}_all", " UNION ALL ".join(finals)))
    return steps, f_tail(f"SELECT * FROM {prefix}_all")


def least_squares_sql(
    source: str, keys: str, carry: list[str], features: list[str], target: str, train: str, prefix: str, constant: str = "1.0"
) -> tuple[list[tuple[str, str]], str]:
    """Named steps leaving (carry, t, h): residual and leverage of a fit on the rows where `train` holds.

    `constant` is the column of the intercept; 0.0 leaves it out (there is no leverage then).

    Pivots are swept with coefficients from the training rows only, so `t` is the out-of-sample
    residual on the other rows.
    """
    part = f"(PARTITION BY {keys})" if keys else "()"
    lead = ", ".join(([keys] if keys else []) + carry)
    columns = ["v0", *[f"v{i + 1}" for i in range(len(features))]]
    first = ", ".join([f"{constant} AS v0", *[f"CAST({f} AS DOUBLE) AS v{i + 1}" for i, f in enumerate(features)]])
    present = " AND ".join(f"{c} IS NOT NULL" for c in [*features, target])
    steps = [(f"{prefix}_0", f"SELECT {lead}, {train} AS tr, {first}, CAST({target} AS DOUBLE) AS t, 0.0 AS h FROM {source} WHERE {present}")]
    for j, pivot in enumerate(columns):
        norm = f"NULLIF(SUM(CASE WHEN tr THEN {pivot} * {pivot} END) OVER {part}, 0)"
        rest = [*columns[j + 1 :], "t"]
        swept = ", ".join(
            f"{c} - COALESCE(SUM(CASE WHEN tr THEN {c} * {pivot} END) OVER {part} / {norm}, 0) * {pivot} AS {c}" for c in rest
        )
        steps.append(
            (f"{prefix}_{j + 1}", f"SELECT {lead}, tr, {swept}, h + {pivot} * {pivot} / {norm} AS h FROM {prefix}_{j}")
        )
    return steps, f"{prefix}_{len(columns)}"


def normal_cdf(x: str, points: int = 1000) -> str:
    """Scalar expression: standard normal distribution function by Simpson's rule."""
    return (
        f"(0.5 + (SELECT SUM((CASE WHEN i IN (0, {points}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) "
        f"* exp(-pow(({x}) * i / {points}, 2) / 2)) FROM range(0, {points} + 1) g(i)) * ({x}) / {points} / 3 / sqrt(2 * pi()))"
    )


def adf_sql(source: str, keys: str, most: int, prefix: str) -> tuple[list[tuple[str, str]], str]:
    """Unit-root test of (keys, ts, value): named steps and the name of (keys, used_lag, n, statistic, p_value, status).

    `most` is at least the longest lag any group may use.
    """
    part, order = f"(PARTITION BY {keys})", f"(PARTITION BY {keys} ORDER BY ts)"
    past = ", ".join(f"LAG(d, {k}) OVER {order} AS d{k}" for k in range(1, most + 1))
    steps = [
        (
            f"{prefix}_change",
            f"SELECT {keys}, ts, value - LAG(value) OVER {order} AS d, LAG(value) OVER {order} AS level, "
            f"COUNT(*) OVER {part} AS nv FROM {source} WHERE value IS NOT NULL",
        ),
        (
            f"{prefix}_rows",
            f"SELECT {keys}, ts, d, level, ROW_NUMBER() OVER {order} AS pos, {past}, "
            "GREATEST(LEAST(CEIL(12 * POW(nv / 100, 0.25)), FLOOR(nv / 2) - 2), 0) AS max_lag "
            f"FROM {prefix}_change WHERE d IS NOT NULL",
        ),
    ]
    # One chain over the common sample gives the residual length after every further lag.
    regressors = ["1.0 AS v0", "level AS v1", *[f"d{k} AS v{k + 1}" for k in range(1, most + 1)]]
    steps.append(
        (f"{prefix}_c0", f"SELECT {keys}, max_lag, {', '.join(regressors)}, d AS t FROM {prefix}_rows WHERE pos > max_lag")
    )
    carry = ["max_lag"]
    for j in range(most + 2):
        rest = [f"v{k}" for k in range(j + 1, most + 2)] + ["t"]
        sql = _sweep(f"{prefix}_c{j}", keys, rest, f"v{j}", carry)
        if j >= 1:
            sql = f"SELECT *, t AS s{j - 1} FROM ({sql})"
            carry = [*carry, f"s{j - 1}"]
        steps.append((f"{prefix}_c{j + 1}", sql))
    scores = " UNION ALL ".join(
        f"SELECT {keys}, {k} AS k, COUNT(*) * ln(NULLIF(SUM(s{k} * s{k}), 0) / COUNT(*)) + 2 * ({k} + 2) AS aic "
        f"FROM {prefix}_c{most + 2} WHERE max_lag >= {k} GROUP BY ALL"
        for k in range(most + 1)
    )
    steps.append((f"{prefix}_aic", scores))
    steps.append(
        (f"{prefix}_best", f"SELECT {keys}, k FROM {prefix}_aic WHERE aic IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY aic, k) = 1")
    )
    finals = []
    for k in range(most + 1):
        name = f"{prefix}_f{k}_"
        columns = ["1.0 AS v0", *[f"d{i} AS v{i}" for i in range(1, k + 1)], f"level AS v{k + 1}"]
        steps.append(
            (
                f"{name}0",
                f"SELECT {keys}, {', '.join(columns)}, d AS t FROM {prefix}_rows JOIN {prefix}_best USING ({keys}) "
                f"WHERE k = {k} AND pos > {k}",
            )
        )
        carry = []
        for j in range(k + 2):
            rest = [f"v{i}" for i in range(j + 1, k + 2)] + ["t"]
            source_ = f"{name}{j}"
            if j == k + 1:
                source_ = f"(SELECT *, t AS r, v{j} AS lv FROM {source_})"
                carry = ["r", "lv"]
            steps.append((f"{name}{j + 1}", _sweep(source_, keys, rest, f"v{j}", carry)))
        finals.append(
            f"SELECT {keys}, {k} AS used_lag, COUNT(*) AS n, CASE WHEN COUNT(*) > {k + 2} THEN SIGN(SUM(r * lv)) "
            f"* SQRT(GREATEST(SUM(r * r) - SUM(t * t), 0) / (NULLIF(SUM(t * t), 0) / (COUNT(*) - {k + 2}))) END AS statistic "
            f"FROM {name}{k + 2} GROUP BY ALL"
        )
    steps.append((f"{prefix}_stat", " UNION ALL ".join(finals)))
    low = "2.1659 + 1.4412 * statistic + 0.038269 * statistic ** 2"
    high = "1.7339 + 0.93202 * statistic - 0.12745 * statistic ** 2 - 0.010368 * statistic ** 3"
    steps.append(
        (
            f"{prefix}_z",
            f"SELECT *, CASE WHEN statistic <= -1.61 THEN {low} ELSE {high} END AS z FROM {prefix}_stat",
        )
    )
    steps.append(
        (
            f"{prefix}_found",
            f"SELECT * EXCLUDE z, CASE WHEN statistic > 2.74 THEN 1.0 WHEN statistic < -18.83 THEN 0.0 ELSE {normal_cdf('z')} END "
            f"AS p_value FROM {prefix}_z WHERE statistic IS NOT NULL",
        )
    )
    # Series without a statistic stay, as untestable.
    steps.append(
        (
            f"{prefix}_test",
            f"SELECT *, CASE WHEN statistic IS NULL THEN 'untestable' ELSE 'tested' END AS status "
            f"FROM (SELECT DISTINCT {keys} FROM {source}) LEFT JOIN {prefix}_found USING ({keys})",
        )
    )
    return steps, f"{prefix}_test"


def difference_sql(source: str, order: int) -> str:
    """(series_id, "order", ts, value): n-th difference of (series_id, ts, value) by repeated subtraction."""
    sql = f"SELECT series_id, ts, value FROM {source} WHERE value IS NOT NULL"
    for _ in range(order):
        sql = f"SELECT series_id, ts, value - LAG(value) OVER (PARTITION BY series_id ORDER BY ts) AS value FROM ({sql})"
    return f'SELECT series_id, {order} AS "order", ts, value FROM ({sql}) WHERE value IS NOT NULL'
