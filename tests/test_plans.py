"""How often the reports read their tables, counted in the plans."""

import re
from collections import Counter

import pytest

from shopledger.plans.queries import QUERIES


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return Counter(re.findall(r"Location: InMemoryFileIndex\(\d+ paths?\)\[[^\]]*?/(\w+)\.parquet", plan))


@pytest.mark.parametrize(
    "name, table, most",
    [
        ("frequency_changes", "orders", 2),  # fees and renewals
        ("renewal_gap_enriched", "orders", 7),  # six tables of it, of which renewals twice
        ("blocked_payments_daily", "events", 5),  # blocked ones twice: once for the fallback device
        ("bundle_repurchase", "lineitem", 1),
        ("bundle_repurchase", "orders", 2),  # the first-order flag of the test table is one
        ("kpi_tracker", "lineitem", 2),
        ("kpi_tracker", "orders", 7),
        ("tracker_merge", "orders", 5),
        ("daily_orders_kpi", "lineitem", 2),
    ],
)
def test_reads(spark, data, name, table, most):
    assert 0 < scans(QUERIES[name](spark, data))[table] <= most


@pytest.mark.parametrize("name", ["cancellation_base", "active_distribution", "investor_cohorts"])
def test_questionnaires_are_parsed_once(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("from_json", plan)) <= 2


def test_checkouts_are_parsed_once(spark, data):
    plan = QUERIES["basket_summary"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("from_json", plan)) == 1


def test_periods_share_their_reads(spark, data):
    assert scans(QUERIES["repurchase_period_table"](spark, data)) == scans(QUERIES["repurchase_by_answer"](spark, data))


def test_bundles_collect_nothing(spark, data):
    assert "collect_" not in QUERIES["bundle_repurchase"](spark, data)._jdf.queryExecution().executedPlan().toString()
