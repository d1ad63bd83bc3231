"""What the plans must look like."""

import re

import pytest

import __spark_entry__ as entry
from sluicework.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan_of(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    # Without broadcasts the plans are those of large tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    result = {name: plan_of(spark, name) for name in QUERIES}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return result


def test_no_query_has_a_cross_join_or_python(plans):
    for name, plan in plans.items():
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEvalPython", "MapInPandas"):
            assert unwanted not in plan, f"{unwanted} in {name}"


def test_no_query_puts_all_rows_into_one_task(plans):
    for name, plan in plans.items():
        assert "Window [" not in plan, name
        for line in plan.splitlines():
            if "Exchange SinglePartition" in line:
                # only partial aggregates and table counts may meet in one task
                at = plan.splitlines().index(line)
                below = plan.splitlines()[at + 1]
                assert "Aggregate" in below, f"{name}: {below}"


def test_no_query_asks_for_a_broadcast(plans):
    for name, plan in plans.items():
        assert "BroadcastHashJoin" not in plan, name


@pytest.mark.parametrize("name, columns", [
    ("report_by_group", {"l_orderkey", "l_shipdate", "o_orderkey", "o_orderdate", "o_orderpriority"}),
    ("count_by_category", {"event_type"}),
    ("quantity_of", {"l_orderkey", "l_partkey"}),
    ("header_detail_counts", {"o_orderkey", "o_orderstatus", "l_orderkey", "l_returnflag"}),
    ("fold_events", {"event_id", "ts", "user_id", "event_type", "value"}),
    ("length_profile", {"text"}),
    ("distinct_values", {"lang"}),
])
def test_scans_read_only_the_columns_they_need(plans, name, columns):
    read = set()
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plans[name]):
        read |= {field.split(":")[0] for field in schema.split(",") if field}
    assert read == columns


@pytest.mark.parametrize("name, pushed", [
    ("scan_query", "GreaterThan(o_totalprice,100000.0)"),
    ("inc_high_water", "GreaterThan(o_orderkey,"),
    ("inc_bounded", "LessThanOrEqual(l_orderkey,"),
    ("inc_changed", "GreaterThan(o_orderdate,"),
    ("log_read_first_n", "LessThan(event_id,"),
    ("doc_find", "EqualTo(c_mktsegment,BUILDING)"),
])
def test_filters_reach_the_scan(plans, name, pushed):
    assert pushed in plans[name]


def test_lines_are_reduced_before_they_are_joined(plans):
    for name in ("report_by_group", "report_by_date", "total_minutes"):
        before_join = plans[name].split("SortMergeJoin")[1]
        assert "partial_sum" in before_join or "partial_count" in before_join


def test_top_rows_never_sort_the_table(plans):
    for name in ("top_k", "doc_find", "pick_one"):
        assert "TakeOrderedAndProject" in plans[name] and "Exchange" not in plans[name]


def test_one_shuffle_for_row_equality(plans):
    assert plans["rows_equal"].count("Exchange hashpartitioning") == 1
