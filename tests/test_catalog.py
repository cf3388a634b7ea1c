"""Every catalogue query against its SQL, and the shape of its plan."""

import os
import re

import pytest

import __spark_entry__ as driver
import oracle
from viewtide.plans.catalog import load

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CATALOG = load()


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.sql])
def test_query_equals_sql(spark, connection, name):
    result = CATALOG[name].run(spark, SF_DIR)
    assert oracle.difference(result, connection, CATALOG[name].sql) is None


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if not q.sql])
def test_query_without_sql_runs(spark, name):
    assert CATALOG[name].run(spark, SF_DIR).count() > 0


def plan(spark, name):
    result = CATALOG[name].run(spark, SF_DIR)
    return result._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", [n for n in CATALOG if not n.startswith("stream_")])
def test_plan_has_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_what_they_need(spark):
    text = plan(spark, "monthly_engagement")
    lineitem = re.search(r"ReadSchema: (struct<l_\S+)", text).group(1)
    assert "l_extendedprice" not in lineitem and "l_tax" not in lineitem
    assert "IsNotNull(l_shipdate)" in text


def test_user_metrics_reduce_sessions_before_the_user_join(spark):
    for name in ("cohort_retention", "monthly_churn", "monthly_active_users", "user_cohorts"):
        text = plan(spark, name)
        # The reviews are not needed, and sessions are grouped below the join.
        assert "l_tax" not in text
        assert text.count("lineitem.parquet") == 1
        lines = text.splitlines()
        grouped = max(i for i, l in enumerate(lines) if "HashAggregate(keys=[user_id" in l)
        scan = next(i for i, l in enumerate(lines) if "lineitem.parquet" in l)
        joined = [i for i, l in enumerate(lines) if "Join [user_id" in l]
        assert joined and max(joined) < grouped < scan


def test_driver_contract(spark):
    result = driver.entry(spark)
    assert result.count() == 3496
    queries, sql = driver.queries(), driver.oracle_sql()
    assert set(sql) <= set(queries)
    assert result.columns[:4] == ["watch_year", "watch_month", "country", "subscription_plan"]


@pytest.mark.parametrize(
    "name", ["content_performance", "genre_performance", "monthly_engagement", "genre_trend"]
)
def test_distinct_counts_do_not_expand_rows(spark, name):
    plan = CATALOG[name].run(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
