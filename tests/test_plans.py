"""Plan shape: filters reach the parquet scan, scans read only used columns,
aggregations run partial + final, dimensions are broadcast after a check."""

import contextlib
import io
import re

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"


def _plan(spark, key):
    """The formatted explain text (scan metadata such as PushedFilters in full)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        entry_mod.queries()[key](spark, SF).explain("formatted")
    return buf.getvalue()


def test_label_filter_reaches_the_orders_scan(spark):
    plan = _plan(spark, "hired_by_branch")
    assert "EqualTo(o_orderstatus,F)" in plan
    # orders counted per client before the join: partial + final count
    assert plan.count("partial_count") >= 1


def test_equality_filter_pushed(spark):
    assert "EqualTo(o_orderpriority,1-URGENT)" in _plan(spark, "filter_eq")
    assert "EqualTo(event_type,purchase)" in _plan(spark, "count_value")
    assert "EqualTo(p_brand,Brand#13)" in _plan(spark, "filter_join_project")


def test_projection_prunes_the_scan(spark):
    plan = _plan(spark, "project_columns")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema == "l_orderkey:bigint,l_partkey:bigint,l_quantity:double"


def test_range_filters_pushed_into_fact_scan(spark):
    plan = _plan(spark, "filter_conjunction")
    assert "GreaterThan(l_quantity,10.0)" in plan and "LessThan(l_quantity,40.0)" in plan


def test_star_join_broadcasts_checked_dimensions(spark):
    plan = _plan(spark, "star_join_features")
    assert "BroadcastHashJoin" in plan
    # no column of the wide tables is read unless used
    assert "c_name" not in plan and "o_orderdate" not in plan
