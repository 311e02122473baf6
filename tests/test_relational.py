import pytest
from pyspark.sql import functions as F

from quarry.operators import relational as rel
from quarry.sources import from_list

def _harbour_log(spark, shout_every=0):
    """23 entries by rule: every fifth is "Heron", the others are numbered buoys."""
    names = ["Heron" if i % 5 == 2 else f"Buoy {i}" for i in range(23)]
    if shout_every:
        names = [n.upper() if i % shout_every == 0 else n for i, n in enumerate(names)]
    return from_list(spark, names, "title")


def test_count_value_is_repeatable(spark):
    log = _harbour_log(spark)
    assert [rel.count_value(log, "title", "Heron").first().n for _ in range(2)] == [5, 5]


def test_count_value_case_insensitive(spark):
    log = _harbour_log(spark, shout_every=2)  # places 2, 12 and 22 are in capitals
    assert rel.count_value(log, "title", "Heron").first().n == 2
    assert rel.count_value_ci(log, "title", "Heron").first().n == 5
    lowered = log.select(F.lower("title").alias("title"))
    assert lowered.filter(F.col("title") == "heron").count() == 5
    assert log.filter(F.col("title") == "heron").count() == 0  # the source is unchanged


def test_group_count_and_nonnull_count(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, "b")], "id int, g string")
    by_rows = {r.g: r["count"] for r in rel.group_count(df, "g").collect()}
    by_ids = {r.g: r.n for r in rel.group_count_nonnull(df, ["g"], "id", "n").collect()}
    assert by_rows == {"a": 2, "b": 1}
    assert by_ids == {"a": 1, "b": 1}


def test_numeric_summary_matches_describe(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, -32.0), (4.0, 53.0), (None, 0.0)], "x double, y double")
    got = {r.column_name: r for r in rel.numeric_summary(df, ["x", "y"]).collect()}
    desc = {r.summary: r for r in df.describe("x", "y").collect()}
    for c in ("x", "y"):
        assert got[c]["count"] == int(desc["count"][c])
        assert got[c]["mean"] == pytest.approx(float(desc["mean"][c]), abs=1e-6)
        assert got[c]["stddev"] == pytest.approx(float(desc["stddev"][c]), abs=1e-6)
        assert got[c]["min"] == float(desc["min"][c]) and got[c]["max"] == float(desc["max"][c])


def test_summary_by_group_equals_filter_then_summary(spark):
    rows = [(g, float(v), float(v * v)) for g in range(3) for v in range(g, g + 5)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    grouped = {(r.g, r.column_name): r for r in rel.summary_by_group(df, "g", ["a", "b"]).collect()}
    for g in range(3):
        single = rel.numeric_summary(df.filter(F.col("g") == g), ["a", "b"]).collect()
        for r in single:
            assert grouped[(g, r.column_name)].asDict() == {"g": g, **r.asDict()}


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "term string, n long")
    got = [r.term for r in rel.top_k_by_count(df, "term", "n", 3).collect()]
    assert got == ["c", "a", "b"]


def test_sorted_limit_takes_first_rows(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    assert [r.k for r in rel.sorted_limit(df, 3, ["k"]).collect()] == [0, 1, 2]
