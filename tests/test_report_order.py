"""Row order of the reports (the DuckDB check is order-insensitive)."""

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"


def _rows(spark, key):
    return [tuple(r) for r in entry_mod.queries()[key](spark, SF).collect()]


def test_alias_shadows_column_in_sql_order_by(spark):
    # ORDER BY hired sorts by the count aliased "hired", not by the label column
    counts = [r[0] for r in _rows(spark, "sql_hired_by_branch")]
    assert counts == sorted(counts) and len(counts) > 1


def test_ascending_and_descending_reports(spark):
    asc = [r[0] for r in _rows(spark, "hired_by_branch")]
    assert asc == sorted(asc)
    desc = [r[0] for r in _rows(spark, "hired_by_rank")]
    assert desc == sorted(desc, reverse=True)
    months = [r[1] for r in _rows(spark, "created_by_month")]
    assert months == sorted(months)


def test_top_terms_order_and_tie_break(spark):
    rows = _rows(spark, "top_terms")
    assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
