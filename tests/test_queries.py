"""Registered queries against their SQL. ``TALLYHOUSE_ALL=1`` runs all of them."""

import os
from pathlib import Path

import pytest

from oracle_check import compare, connect
from tallyhouse.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
SAMPLE = ["append_newer_events", "table_order_summary", "categories_strict", "last_touch_join",
          "pivot_spend_by_status", "customer_profile", "campaign_roi", "optin_status",
          "staff_kpis", "product_history", "log_fail_summary"]
NAMES = list(QUERIES) if os.environ.get("TALLYHOUSE_ALL") else SAMPLE


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    _, problem = compare(spark, connect(SF), name, QUERIES[name], ORACLE.get(name), SF)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
