import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.operators import features as fx
from quarry.operators import models

def _weather_notes(n, first=0):
    """``id, text, label`` by rule: notes that name the sun are 1, notes that name rain are 0."""
    sky = ["sunny", "rainy", "rainy"]
    place = ["harbour", "valley", "ridge", "meadow", "town"]
    return [
        (first + i, f"{sky[i % 3]} morning over the {place[i % 5]} number {i % 4}", float(i % 3 == 0)) for i in range(n)
    ]


TRAIN = _weather_notes(30)
TEST = [(i, t) for i, t, _ in _weather_notes(9, first=100)]


def test_text_classifier_pipeline(spark):
    train = spark.createDataFrame(TRAIN, "id long, text string, label double")
    test = spark.createDataFrame(TEST, "id long, text string")
    pipeline, _, _ = models.text_classifier(max_iter=10)
    out = pipeline.fit(train).transform(test).select("id", "probability", "prediction").collect()
    assert [r.prediction for r in out] == [y for *_, y in _weather_notes(9)]
    assert all(abs(sum(r.probability) - 1.0) < 1e-9 for r in out)


def test_grid_search_uses_all_combinations(spark):
    train = spark.createDataFrame(TRAIN * 3, "id long, text string, label double")
    train = train.withColumn("k", F.monotonically_increasing_id()).withColumn("fold", models.fold_column("k", 3))
    cv = models.grid_search(train, [10, 100, 1000], [0.1, 0.01], "fold", max_iter=5, parallelism=1)
    assert len(cv.avgMetrics) == 6


def test_grid_search_splits_texts_once_and_fits_the_same(spark):
    train = spark.createDataFrame([(i, f"{t} {i % 4}", y) for i, (_, t, y) in enumerate(TRAIN * 6)], "id long, text string, label double")
    seen = spark.sparkContext.accumulator(0)

    def read(text):
        seen.add(1)
        return text

    counted = train.withColumn("text", F.udf(read)("text").alias("text")).withColumn("fold", models.fold_column("id", 3))
    cv = models.grid_search(counted, [8, 50], [0.1, 0.01], "fold", max_iter=5, keep_models=True)
    assert 0 < seen.value <= 2 * train.count()
    plain, tf, lr = models.text_classifier(max_iter=5)
    folds = train.withColumn("fold", models.fold_column("id", 3))
    for params, model in zip(cv.getEstimatorParamMaps(), cv.subModels[1]):
        named = {p.name: v for p, v in params.items()}
        alone = plain.fit(folds.where("fold <> 1"), {tf.numFeatures: named["numFeatures"], lr.regParam: named["regParam"]})
        assert np.allclose(model.stages[-1].coefficients.toArray(), alone.stages[-1].coefficients.toArray())
        got, want = (m.transform(train).select("id", "prediction", vector_to_array("probability")[1].alias("p")).collect() for m in (model, alone))
        assert [(r.id, r.prediction) for r in got] == [(r.id, r.prediction) for r in want] and np.allclose([r.p for r in got], [r.p for r in want])


def test_kmeans_assigns_nearest_centre_and_is_layout_independent(spark):
    rng = np.random.default_rng(3)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(200, 2)) + np.repeat([[0, 0], [6, 6]], 100, axis=0))]
    df = fx.assemble(spark.createDataFrame(pts, "id long, x double, y double"), ["x", "y"], "f")
    results = []
    for n in (1, 3, 7):
        laid = models.stable_layout(df.repartition(n), ["id"], 4)
        m = models.kmeans(laid, 2, "f", seed=1)
        centres = [c.tolist() for c in m.clusterCenters()]
        got = m.transform(laid).select("id", vector_to_array("f").alias("v"), "prediction").collect()
        for r in got:
            d = [sum((a - b) ** 2 for a, b in zip(r.v, c)) for c in centres]
            assert r.prediction == int(np.argmin(d))
        results.append(sorted(round(c[0], 6) for c in centres))
    assert results[0] == results[1] == results[2]


def test_trees_predict_known_labels(spark):
    rows = [(i, float(i % 2), float(i % 2) * 3.0 + 0.1 * (i % 5)) for i in range(200)]
    df = fx.assemble(spark.createDataFrame(rows, "id long, label double, x double"), ["x"], "f")
    tree = models.decision_tree(df, "label", "f")
    forest = models.random_forest(df, "label", "f", num_trees=5)
    for m in (tree, forest):
        acc = m.transform(df).filter(F.col("label") == F.col("prediction")).count() / 200
        assert acc == 1.0


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    m = models.materialize(df)
    assert m.count() == 100
    plan = m._jdf.queryExecution().analyzed().toString()
    assert "Relation" in plan and "parquet" in plan and "Project" not in plan
