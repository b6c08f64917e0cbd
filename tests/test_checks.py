"""Each registered query against its SQL, and what the plans must and must not hold."""

import importlib.util
import os

import pytest

from checks import QUERIES, SQL
from compare import connect, differences

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    difference, _ = differences(spark, db, QUERIES[name], SQL[name], SF_DIR)
    assert difference == ""


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    spec = importlib.util.spec_from_file_location("entry", f"{ROOT}/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(QUERIES) <= set(module.queries()) and set(SQL) <= set(module.oracle_sql()) <= set(module.queries())
    assert set(QUERIES) == set(SQL)
    assert module.entry(spark).count() > 0


def test_universe_is_hashed_first(spark):
    text = plan(spark, "share_universe")
    assert "HashAggregate(keys=[user_id" in text and "partial_max(ts" in text


def test_marks_and_bounds_are_hashed(spark):
    for name in ("high_water", "page_bounds", "incremental_pages", "endpoint_scorecard", "progress"):
        text = plan(spark, name)
        assert "SortAggregate" not in text and "Window" not in text, name


def test_small_share_side_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(spark, "enrich_share")


def test_no_cartesian_product_or_python_in_any_plain_query(spark):
    eager = ("feed_", "stream_", "upsert_merge", "upsert_touched", "route_", "jsonl_", "retention", "newest_", "dump_", "influx_", "mixed_", "odd_", "upsert_null", "metrics_", "rejects_", "page_deep")
    for name in QUERIES:
        if not name.startswith(eager):
            text = plan(spark, name)
            assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text, name


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "date_before_space")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "PushedFilters: [IsNotNull(o_totalprice)" not in text
