"""Every query with a SQL equivalent gives the same rows, columns and values."""

import pytest
from check_oracle import compare

import __spark_entry__ as entry_points
from blockpulse.session import scratch_run

ORACLE = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf, oracle, name):
    with scratch_run(spark):
        assert compare(QUERIES[name](spark, sf), oracle, ORACLE[name]) is None


def test_oracle_names_are_queries():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["trend", "month", "rate_of_change", "avg_sale", "rank"]
    assert result.count() > 0
