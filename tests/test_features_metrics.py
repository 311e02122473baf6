import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.operators import features as fx
from quarry.operators import metrics


def test_one_hot_literal_frame(spark):
    df = spark.range(20).select((F.col("id") % 5).cast("double").alias("c1"), (F.col("id") % 4).cast("double").alias("c2"))
    dropped = fx.one_hot(df, ["c1", "c2"], drop_last=True)
    for r in dropped.select("c1", "c2", vector_to_array("c1Vec").alias("a"), vector_to_array("c2Vec").alias("b")).collect():
        assert r.a == [float(r.c1 == i) for i in range(4)]  # the last category is all zeros
        assert r.b == [float(r.c2 == i) for i in range(3)]
    kept = fx.one_hot(df, ["c1"], drop_last=False).select(vector_to_array("c1Vec").alias("a")).collect()
    assert all(sum(r.a) == 1.0 and len(r.a) == 5 for r in kept)


def test_string_index_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", "b", "a", "c"]], "v string")
    got = {r.v: r.vIndex for r in fx.string_index(df, ["v"]).distinct().collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_string_index_has_no_category_limit_and_refuses_null(spark):
    df = spark.range(3000).select(F.format_string("%05d", F.col("id")).alias("v"))
    assert fx.string_index(df, ["v"]).where(F.col("v").cast("double") != F.col("vIndex")).count() == 0
    with pytest.raises(Exception, match="NULL category"):
        fx.string_index(spark.createDataFrame([(None,), ("a",)], "v string"), ["v"]).collect()


def test_scale_and_normalize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (0.0, 0.0)], "x double, k double")
    vec = fx.assemble(df, ["x", "k"], "v")
    scaled = fx.standard_scale(vec, "v", "s").select(vector_to_array("s").alias("s")).collect()
    sd_x = (sum((v - 4 / 3) ** 2 for v in (1, 3, 0)) / 2) ** 0.5
    assert scaled[1].s[0] == pytest.approx(3 / sd_x)
    normed = fx.normalize(vec, "v", "n", 1.0).select(vector_to_array("n").alias("n")).collect()
    assert normed[0].n == pytest.approx([1 / 6, 5 / 6]) and normed[2].n == [0.0, 0.0]


def test_hash_split_is_partition_independent_and_complete(spark):
    base = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = fx.hash_split(base.repartition(3), "k", [0.7, 0.3], ["train", "test"])
    b = fx.hash_split(base.repartition(11), "k", [0.7, 0.3], ["train", "test"])
    sa = {(r.k, r.split) for r in a.collect()}
    sb = {(r.k, r.split) for r in b.collect()}
    assert sa == sb and len(sa) == 5000
    share = sum(1 for _, s in sa if s == "train") / 5000
    assert 0.65 < share < 0.75
    nested = fx.hash_split_nested(base, "k", 0.1, 0.65, ["h", "tr", "te"]).groupBy("split").count().collect()
    n = {r.split: r["count"] for r in nested}
    assert sum(n.values()) == 5000 and 0.07 < n["h"] / 5000 < 0.13


def test_metrics_match_evaluator(spark):
    rows = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(1.0, 0.0)] * 1 + [(2.0, 0.0)] * 2 + [(2.0, 2.0)]
    pred = spark.createDataFrame(rows, "label double, prediction double")
    m = metrics.classification_metrics(pred).first()
    ev = lambda name: MulticlassClassificationEvaluator(metricName=name).evaluate(pred)
    assert m.weighted_f1 == pytest.approx(ev("f1"), abs=1e-6)
    assert m.accuracy == pytest.approx(ev("accuracy"), abs=1e-6)
    assert m.weighted_precision == pytest.approx(ev("weightedPrecision"), abs=1e-6)
    assert m.weighted_recall == pytest.approx(ev("weightedRecall"), abs=1e-6)
    assert m.f1_error == pytest.approx(1 - ev("f1"), abs=1e-6)
    conf = {(r.label, r.prediction): r.n for r in metrics.confusion_counts(pred).collect()}
    assert conf[(0.0, 0.0)] == 5 and sum(conf.values()) == len(rows)


def test_active_features_keeps_varying_slots(spark):
    df = spark.createDataFrame([(1.0, "a", 7.0), (2.0, "b", 7.0), (3.0, "a", 7.0)], "x double, c string, k double")
    hashed = fx.feature_hash(df, ["x", "c", "k"], "h")
    act = fx.active_features(hashed, "h", "a").select(vector_to_array("a").alias("a")).collect()
    assert len(act[0].a) == 3  # x, c=a, c=b vary; the constant k is dropped


def test_pca_refuses_wide_input(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    with pytest.raises(ValueError):
        fx.pca(fx.assemble(df, ["x", "y"], "v"), "v", "p", k=1, width=1 << 18)


def test_sparse_vector_parts(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(1, Vectors.sparse(1 << 18, [3, 70000], [2.0, 1.0])), (2, Vectors.dense([0.5, 0.0]))], ["id", "v"]
    )
    got = {r.id: (r.size, r.indices, r.values) for r in fx.sparse_vector_parts(df, "v", ["id"]).collect()}
    assert got[1] == (1 << 18, [3, 70000], [2.0, 1.0])
    assert got[2] == (2, [0, 1], [0.5, 0.0])


def test_one_hot_keys_give_every_slot(spark, tmp_path):
    from quarry.plans import feature_keys
    from quarry.sources.tables import Warehouse

    orders = [(1, "a"), (2, "a"), (3, "b"), (4, "c")]
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    index = {"a": 0, "b": 1, "c": 2}
    for key, width in ((feature_keys.one_hot_all, 3), (feature_keys.one_hot_drop_last, 2)):
        got = sorted(tuple(r) for r in key(Warehouse(spark, str(tmp_path))).collect())
        assert got == [(k, s, float(index[v] == s)) for k, v in orders for s in range(width)]
