"""Payloads that were stored ahead give the same rows as those made on the way."""

import pytest

import __spark_entry__ as entry_points
from blockpulse.listing_fixture import payloads, stored_payloads
from blockpulse.session import scratch_run, shared_path


@pytest.mark.parametrize("name", ["school_summary", "listing_document", "max_value_filter", "lead_list", "repair_json"])
def test_stored_payloads_change_nothing(spark, sf, name):
    query = entry_points.queries()[name]
    with scratch_run(spark):
        made = sorted(map(str, query(spark, sf).collect()))
        with stored_payloads(spark, sf, shared_path(spark, "payloads")):
            assert any("payloads" in f for f in payloads(spark, sf).inputFiles())
            assert sorted(map(str, query(spark, sf).collect())) == made
        assert any("orders" in f for f in payloads(spark, sf).inputFiles())
