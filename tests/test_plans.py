"""Shapes of physical plans: what must not happen at scale."""

import pytest

from careledger.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Queries whose work is done when they return; their plan only reads the result.
LOADS = {n for n in QUERIES if n.startswith(("load_", "metadata_run", "data_run", "incremental", "clean_", "stateful_", "merge_"))}


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LOADS))
def test_no_pairwise_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name, operator", [
    ("ghost_report", "LeftAnti"), ("missing_periods", "LeftAnti"), ("ghost_delete", "LeftSemi"),
    ("upsert_values", "FullOuter"), ("keep_last", "WindowGroupLimit"), ("reporting_pivot", "partial_max_by"),
    ("tracked_assignments", "LeftSemi"), ("work_reporting", "partial_collect_set"),
])
def test_expected_operator(spark, name, operator):
    assert operator in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "insert_if_absent")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in text


def test_checks_scan_a_table_once(spark):
    text = plan(spark, "table_checks")
    assert text.count("o_orderpriority") and text.count("/orders.parquet") == 1


def test_json_is_parsed_once(spark):
    text = plan(spark, "explode_values")
    assert text.count("from_json") == 1


def test_only_names_leave_the_jvm(spark):
    with_python = [n for n in sorted(set(QUERIES) - LOADS) if "Python" in plan(spark, n)]
    assert with_python == ["sanitize_names"]
