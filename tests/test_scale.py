"""What a pass moves or holds: packed points, one draw per row and tree, narrow stored rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.operators import clustering, decomposition, forest, packed, sampling
from quarry.operators import features as fx
from quarry.plans import exact_keys, learning_keys, model_jobs


def test_a_task_of_k_means_hands_back_one_sum_per_centre_and_slot():
    batch = pa.RecordBatch.from_arrays([packed._binary(np.array([2, 0, 1]), np.array([3, 9, 3], np.int32)), packed._binary(np.array([2, 0, 1]), np.array([1.0, 2.0, 5.0]))], ["slots", "numbers"])
    got = list(clustering._sums(clustering.Centres([0], [{3: 1.0}]))([batch, batch]))
    rows = [tuple(r.values()) for b in got for r in b.to_pylist()]
    assert sorted(rows) == [(0, -1, 6.0), (0, 3, 12.0), (0, 9, 4.0)]


def test_places_in_narrow_and_wide_slots():
    for far in (9, 1 << 30):
        at, held = packed.places(np.array([0, 5, far]), np.array([5, far, 7, 0, far + 1], np.int32))
        assert held.tolist() == [True, True, False, True, False] and at[held].tolist() == [1, 2, 0]
    assert not packed.places(np.zeros(0, np.int64), np.array([1]))[1].any()


def test_packed_rows_keep_nulls_and_empty_lists_as_no_entries(spark):
    rows = [(1, [4, 2], [1.0, 2.0]), (2, [], []), (3, None, None)]
    df = spark.createDataFrame(rows, "id long, indices array<int>, values array<double>").coalesce(1)
    got = {r.id: (np.frombuffer(r.slots, np.int32).tolist(), np.frombuffer(r.numbers).tolist()) for r in packed.pack(df, ["id"]).collect()}
    assert got == {1: ([4, 2], [1.0, 2.0]), 2: ([], []), 3: ([], [])}
    found = decomposition.principal_components(df.where("id < 3"), 1)
    assert found.slots.tolist() == [2, 4] and np.allclose(found.weights[:, 0], np.array([2.0, 1.0]) / 5**0.5)


def test_trees_of_a_forest_read_equal_rows_once(spark, monkeypatch):
    sizes, fit = [], forest.DecisionTreeClassifier.fit
    monkeypatch.setattr(forest.DecisionTreeClassifier, "fit", lambda self, df: sizes.append((df.count(), df.agg(F.sum(self.getWeightCol())).first()[0])) or fit(self, df))
    df = spark.createDataFrame([(i, float(i % 2), float(i % 2), float(i % 3)) for i in range(300)], "id long, label double, x double, y double")
    forest.bagged_trees(df, "label", ["x", "y"], "id", 2, 2, seed=3, parallel=1)
    drawn = [df.agg(F.sum(sampling.bag_weight(3, t, "id"))).first()[0] for t in range(2)]
    assert [w for _, w in sizes] == drawn and all(n == 6 for n, _ in sizes)


def test_bag_weights_follow_the_bounds_of_their_draws(spark):
    rows = spark.range(5000).select(sampling.draw(4, F.lit(1), F.col("id")).alias("u"), sampling.bag_weight(4, 1, "id").alias("w")).collect()
    assert all(r.w == sum(r.u >= b for b in sampling.poisson_bounds()) for r in rows)


def test_bags_are_drawn_once_per_row_and_tree(wh):
    plan = learning_keys.forest_bags(wh)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1


def test_tasks_of_hashed_slots_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(exact_keys, "SLOT_ROWS", 10)
    df = spark.createDataFrame([(i // 2, [1, 2], [1.0, 0.5]) for i in range(95)], "k long, indices array<int>, values array<double>")
    got = exact_keys._slots(df, "k")
    assert got.rdd.getNumPartitions() == 10
    assert {(r.k, r.slot): r.value for r in got.collect()} == {(k, s): v * (2 if k < 47 else 1) for k in range(48) for s, v in ((1, 1.0), (2, 0.5))}


def test_indexed_jobs_write_no_vectors(wh, monkeypatch):
    seen, write = [], model_jobs.models.materialize
    monkeypatch.setattr(model_jobs.models, "materialize", lambda df, *a: seen.append(df.dtypes) or write(df, *a))
    train, test = model_jobs.indexed_features(wh, "A")
    assert train.columns == test.columns == ["row_key", "label", "features"]
    assert seen and all(kind != "vector" for dtypes in seen for _, kind in dtypes)


def test_names_are_hashed_once_each_when_codes_are_fitted(spark, monkeypatch):
    sizes, hashed = [], fx.feature_hash
    monkeypatch.setattr(fx, "feature_hash", lambda df, *a: sizes.append(df.count()) or hashed(df, *a))
    df = spark.createDataFrame([(f"n{i % 4}", float(i % 2)) for i in range(200)] + [(None, 1.0)], "name string, label double")
    bundles = fx.SlotBundles.fit(df, ["name"], "label")
    assert sizes == [4] and bundles.tables["name"].count() == 4
