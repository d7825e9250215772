"""Every listed query against its SQL, and the shape of its plan."""

import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries as every_query
from lotewise.registry import ORACLE, QUERIES
from tools.check_queries import TABLES, compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.queries


def queries():
    """Those of this library's own operators."""
    return QUERIES


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_agrees_with_its_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(every_query()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - {"write_snapshot", "load_new", "geocode_new"}))
def test_no_cross_joins_and_no_rows_through_python(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert operator not in plan
    # every scan reads only what it needs, unless whole rows are the result
    assert "FileScan" in plan or "Scan" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = queries()["period_batches"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_page_reading_shuffles_words_once(spark):
    plan = queries()["grid_fields"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
