"""Scans per plan: feeds of one table share one reading of it."""

import pytest
from pyspark.sql import functions as F

from blockpulse.plans.registry import QUERIES, load_all

load_all()


def scans(df) -> int:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("parquet")


@pytest.mark.parametrize(
    "name, most", [("daily_panel", 3), ("daily_counts", 2), ("cast_dates", 2), ("schema_audit", 2), ("resample", 3), ("cusip8", 2), ("latest_per_key", 2), ("page_payload", 1)]
)
def test_scans(spark, sf, name, most):
    assert 1 <= scans(QUERIES[name](spark, sf)) <= most


def test_listed_inputs_are_written_by_executors(spark, sf, monkeypatch):
    kind = type(spark.range(1))
    for name in ("collect", "toLocalIterator"):
        monkeypatch.setattr(kind, name, lambda *a, **b: pytest.fail("rows came to the driver"))
    chosen = QUERIES["list_inputs"](spark, sf)
    monkeypatch.undo()
    months = spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("month")).count().collect()
    want = sorted((f"JC-{r['month']}.csv.zip", r["count"]) for r in months if int(r["month"]) % 100 % 4)[:-14]
    assert sorted(tuple(r) for r in chosen.collect()) == want
