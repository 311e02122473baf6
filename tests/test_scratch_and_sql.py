"""Written intermediates go with their scope; SQL text with parameters over views on demand."""

import os

import pytest

import __spark_entry__ as entry_mod
from quarry import session
from quarry.operators.models import materialize
from quarry.plans import analog, sql_reports
from quarry.session import checkpoint_root, scratch_scope

SF = "/root/testdata/sf0.001"


def _left(spark):
    return {d for d in os.listdir(checkpoint_root(spark)) if d.startswith("quarry-")}


@pytest.mark.parametrize("key", ["scan_csv", "scan_csv_headerless", "scan_text", "scan_json", "string_index", "kmeans", "decision_stump"])
def test_folder_is_as_before_after_each_key(spark, key):
    before = _left(spark)
    with scratch_scope(spark):
        assert entry_mod.queries()[key](spark, SF).count() > 0
        assert _left(spark) > before
    assert _left(spark) == before


def test_scopes_nest_and_end_on_errors(spark):
    before = _left(spark)
    with pytest.raises(KeyError), scratch_scope(spark):
        outer = materialize(spark.range(5))
        with scratch_scope(spark):
            materialize(spark.range(6))
        assert outer.count() == 5  # the inner scope took only its own
        raise KeyError
    assert _left(spark) == before


def test_tables_of_no_scope_are_kept_until_the_process_ends(spark):
    before = len(session._unscoped)
    table = materialize(spark.range(7))
    assert len(session._unscoped) == before + 1 and table.count() == 7


def test_status_predicate_reaches_the_scan_and_only_named_views_are_registered(spark, wh):
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("dw_")]:
        spark.catalog.dropTempView(name)
    plan = sql_reports.REPORTS["sql_hired_by_rank"](wh)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan
    assert {t.name for t in spark.catalog.listTables() if t.name.startswith("dw_")} == {"dw_hires", "dw_bio"}


def test_parameters_are_values_not_text(wh):
    tables = analog.warehouse_views(wh)
    out = sql_reports.run_statement(wh, "SELECT count(*) AS n FROM {hires} WHERE job_function = :job", tables, {"job": "x' OR '1' = '1"})
    assert out.first().n == 0
