"""Seeded draws, the forest of bags, k-means, Newton steps and the area under the curve against plain Python."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Word2Vec
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quarry.operators import clustering, decomposition, forest, logistic, metrics, models, sampling, tuning
from quarry.operators import features as fx
from quarry.plans import learning_keys, model_jobs


def _draw(seed, *parts):
    named = "".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts)
    return int(hashlib.md5(f"{seed};{named}".encode()).hexdigest()[:12], 16)


def test_random_split_draws_every_row_on_its_own(spark, monkeypatch):
    monkeypatch.setattr(sampling, "PIECE_ROWS", 100)  # the frequent row goes in pieces
    rows = [(1, "a")] * 1001 + [(i, None) for i in range(300)] + [(None, "é")] * 7 + [(None, None)]
    df = spark.createDataFrame(rows, "n long, piece string")
    want = Counter()
    for row, count in Counter(rows).items():
        for number in range(count):
            u = _draw(3, *row, number) / 2**48
            want[(*row, "x" if u < 0.5 else "y" if u < 0.75 else "z")] += 1
    for parts in (1, 5):
        split = sampling.random_split(df.repartition(parts), [2, 1, 1], ["x", "y", "z"], seed=3)
        assert split.columns == ["n", "piece", "split"]
        assert Counter(map(tuple, split.collect())) == want
    assert sampling.random_split(df.limit(0), [1, 1], ["x", "y"], 1).count() == 0
    with pytest.raises(ValueError):
        sampling.random_split(df, [1, -1], ["x", "y"], 1)


def test_bag_weights_are_poisson(spark):
    got = [r.w for r in spark.range(20_000).select(sampling.bag_weight(5, 2, "id").alias("w")).collect()]
    bounds = sampling.poisson_bounds()
    assert got[:200] == [float(sum(_draw(5, 2, i) >= b for b in bounds)) for i in range(200)]
    shares = Counter(got)
    assert all(abs(shares[float(k)] / 20_000 - math.exp(-1) / math.factorial(k)) < 0.015 for k in range(5))


def test_forest_of_bags_learns_and_is_independent_of_partitions(spark):
    rows = [(i, float(i % 2), float(i % 2) * 3 + 0.1 * (i % 5), float(i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, label double, x double, noise double")
    seen = []
    for parts in (1, 6):
        trees = forest.bagged_trees(df.repartition(parts), "label", ["x", "noise"], "id", 5, 2, seed=1, max_depth=2)
        got = forest.majority(forest.votes(trees, df, "id", ["x", "noise"]), "id").collect()
        seen.append(sorted(map(tuple, got)))
    assert seen[0] == seen[1] and all(p == i % 2 and v in (0, 5) for i, v, p in seen[0])


def _lloyd(points, k, steps):
    centres = [max(points, key=lambda p: (p[1] @ p[1], -p[0]))[1]]
    while len(centres) < k:
        far = max(points, key=lambda p: (min((p[1] - c) @ (p[1] - c) for c in centres), -p[0]))
        centres.append(far[1])
    for _ in range(steps + 1):
        near = [int(np.argmin([(x - c) @ (x - c) for c in centres])) for _, x in points]
        centres = [np.mean([x for (_, x), n in zip(points, near) if n == c], axis=0) for c in range(len(centres))]
    return {key: n for (key, _), n in zip(points, near)}


def test_kmeans_equals_plain_lloyd(spark):
    rng = np.random.default_rng(6)
    points = [(i, np.where(rng.random(8) < 0.4, rng.integers(1, 9, 8) + 10.0 * (i % 3), 0.0)) for i in range(200)]
    rows = [(i, np.flatnonzero(x).tolist(), x[x != 0].tolist(), "p") for i, x in points]
    df = spark.createDataFrame(rows, "id long, indices array<int>, values array<double>, tag string").repartition(5)
    got = clustering.kmeans(df, 3, "id", ["tag"], max_steps=5).collect()
    assert {r.id: r.prediction for r in got} == _lloyd(points, 3, 5) and {r.tag for r in got} == {"p"}
    same = spark.createDataFrame([(i, [0], [1.0]) for i in range(9)], "id long, indices array<int>, values array<double>")
    assert {r.prediction for r in clustering.kmeans(same, 4, "id").collect()} == {0}
    zero = spark.createDataFrame([(1, [], [])], "id long, indices array<int>, values array<double>")
    assert [r.prediction for r in clustering.kmeans(zero, 2, "id").collect()] == [0]
    assert clustering.kmeans(same.limit(0), 2, "id").count() == 0


def test_newton_agrees_with_spark(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 2))
    y = (rng.random(500) < 1 / (1 + np.exp(-(0.5 + x @ [1.5, -1.0])))).astype(float)
    df = spark.createDataFrame([(float(c), float(a), float(b)) for (a, b), c in zip(x, y)], "label double, a double, b double")
    w = logistic.newton(df.unionByName(df.limit(3).select("label", F.lit(None).cast("double").alias("a"), "b")), "label", ["a", "b"], 8)
    m = LogisticRegression(maxIter=200, tol=1e-12).fit(fx.assemble(df, ["a", "b"], "features"))
    assert np.allclose(w, [m.intercept, *m.coefficients], atol=1e-5)
    assert logistic.newton(df.limit(0), "label", ["a", "b"], 3).tolist() == [0, 0, 0]


def test_area_counts_ties_as_half_and_skips_nulls(spark):
    rng = np.random.default_rng(8)
    rows = [(g, float(rng.integers(0, 12)), int(rng.random() < 0.3)) for g in "abc" for _ in range(150)]
    df = spark.createDataFrame(rows + [("a", None, 1), ("a", 1.0, None), ("d", 1.0, 1)], "g string, s double, y int")
    got = {r.g: r for r in metrics.area_under_curve(df.repartition(6), "s", "y", ["g"]).collect()}
    for g in "abc":
        up, down = ([s for h, s, y in rows if h == g and y == want] for want in (1, 0))
        area = sum((u > d) + 0.5 * (u == d) for u in up for d in down) / len(up) / len(down)
        assert abs(got[g].auc - area) < 1e-6 and got[g].n == 150 and got[g].positives == len(up)
    assert got["d"].auc is None
    whole = metrics.area_under_curve(df.where("g <> 'd'"), "s", "y").first()
    scored = fx.assemble(df.dropna().where("g <> 'd'").withColumn("label", F.col("y").cast("double")), ["s"], "v")
    assert abs(whole.auc - BinaryClassificationEvaluator(rawPredictionCol="s").evaluate(scored)) < 1e-5


def test_grid_table_has_every_fold_and_agrees_with_the_means(spark):
    rows = [(i, f"{'sunny' if i % 3 else 'rainy'} day {i % 7} {'cold' if i % 5 == 0 else 'warm'}", float(i % 3 == 0 or i % 11 == 0)) for i in range(150)]
    train = spark.createDataFrame(rows, "k long, text string, label double").withColumn("fold", models.fold_column("k", 3))
    fitted = models.grid_search(train, [4, 64], [0.1, 0.01], "fold", max_iter=3, keep_models=True)
    got = tuning.grid_table(train, fitted, "fold").collect()
    assert len(got) == 12 and sum(r.n for r in got) == 4 * 150 and sum(r.best for r in got) == 3
    for params, mean in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics):
        named = {p.name: v for p, v in params.items()}
        own = [r.mean_auc for r in got if (r.num_features, r.reg_param) == (named["numFeatures"], named["regParam"])]
        assert all(abs(m - mean) < 1e-3 for m in own)


def _under(spark, value, run):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", value)
    try:
        return Counter(map(tuple, run().collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("job", [learning_keys.random_split, learning_keys.forest_votes, model_jobs.kmeans])
def test_same_rows_under_two_split_sizes(spark, wh, job):
    assert _under(spark, "134217728", lambda: job(wh)) == _under(spark, "16384", lambda: job(wh))


def test_components_equal_a_full_decomposition(spark):
    rng = np.random.default_rng(9)
    x = np.where(rng.random((300, 40)) < 0.3, rng.normal(size=(300, 40)) * np.linspace(6, 0.5, 40) ** 2, 0.0)
    rows = [(i, np.flatnonzero(r).tolist(), r[r != 0].tolist()) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, indices array<int>, values array<double>").repartition(4)
    found = decomposition.principal_components(df, 3, steps=40)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(found.variances, values[::-1][:3])
    for j in range(3):
        assert abs(abs(found.weights[:, j] @ vectors[found.slots, -1 - j]) - 1) < 1e-6
    got = {r.id: r.components for r in decomposition.project(df, found, ["id"]).collect()}
    assert np.allclose([got[i] for i in range(300)], x[:, found.slots] @ found.weights)
    with pytest.raises(ValueError):
        decomposition.principal_components(df, 41)


def test_mean_vectors_equal_the_model(spark):
    lists = [["a", "b", "a"], ["b"], [], ["unseen", "a"], ["a", "b", "a"]] * 6
    df = spark.createDataFrame([(i, w) for i, w in enumerate(lists)], "id long, words array<string>")
    model = Word2Vec(inputCol="words", outputCol="v", vectorSize=4, minCount=7, seed=3).fit(df)
    want = {r.id: list(r.v) for r in model.transform(df).collect()}
    got = fx.mean_vectors(df.union(spark.createDataFrame([(99, None)], df.schema)), "words", "out", model.getVectors(), 4)
    got = {r.id: r.out for r in got.collect()}
    assert got.pop(99) is None and got.keys() == want.keys()
    assert all(np.allclose(got[i], want[i], atol=1e-7) for i in want)
    with pytest.raises(ValueError):
        fx.word2vec(df, "words", "v", min_count=1, max_words=2)


def test_index_tables_have_no_category_limit_and_survive_saving(spark, tmp_path):
    df = spark.range(250_000).select((F.col("id") % 200_000).cast("string").alias("value"))
    tables = fx.IndexTables.fit(df, ["value"])
    tables.save(str(tmp_path / "tables"))
    again = fx.IndexTables.load(spark, str(tmp_path / "tables"), ["value"])
    got = again.transform(df).agg(F.countDistinct("valueIndex"), F.max("valueIndex"), F.count(F.lit(1))).first()
    assert tuple(got) == (200_000, 199_999.0, 250_000)
    first = again.transform(spark.createDataFrame([("0",)], "value string")).first()
    assert first.valueIndex == 0  # of those that occur twice, the first by name
    with pytest.raises(Exception, match="no index"):
        again.transform(spark.createDataFrame([("x",)], "value string")).collect()


def test_bundles_need_one_feature_per_column_however_many_names(spark):
    rows = [(i, f"name{i % 10_000}", "a" if i % 3 else None, float(i % 10_000 % 10 < 3)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "slot long, name string, other string, label double")
    bundles = fx.SlotBundles.fit(df, ["name", "other"], "label")
    coded = bundles.transform(df)
    assert coded.columns == ["slot", "name", "other", "label", "nameCode", "otherCode"]
    bounds = coded.groupBy("label").agg(F.min("nameCode").alias("low"), F.max("nameCode").alias("high")).orderBy("label").collect()
    assert bounds[0].low == 0 and bounds[1].high > 9500  # a few names share a slot
    x = fx.assemble(coded, ["nameCode", "otherCode"], "x")
    model = models.decision_tree(x, "label", "x", max_depth=4)
    right = model.transform(x).where("label = prediction").count()
    assert model.numFeatures == 2 and right > 0.93 * 20_000
    unseen = bundles.transform(spark.createDataFrame([(1, "stranger", None, 0.0)], df.schema)).first()
    assert unseen.otherCode == -1


def test_vector_entries_have_only_set_slots(spark):
    df = spark.createDataFrame([(1, Vectors.sparse(100_000, [7], [2.0])), (2, Vectors.dense([0.0, 3.0])), (3, Vectors.sparse(5, [], []))], ["id", "v"])
    got = sorted(map(tuple, fx.vector_entries(df, "v", ["id"]).collect()), key=str)
    assert got == [(1, 7, 2.0), (2, 1, 3.0), (3, None, 0.0)]
