"""Registration of queries and of their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blockpulse.oracle import compose

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under a name; `sql` is the equivalent statement for the oracle."""

    def register(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = plan
        if sql is not None:
            ORACLE[name] = compose(sql)
        return plan

    return register


def load_all() -> None:
    # Registration order: quick panel queries first, model fits last.
    from blockpulse.plans import panels, market, property_sales, places, rides, securities  # noqa: F401, I001
    from blockpulse.plans import series, forecasts, documents, sources_sinks, causality, streams, models  # noqa: F401
