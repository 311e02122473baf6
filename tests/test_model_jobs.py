"""Model jobs on sf0.001: properties, not scores (the data are synthetic)."""

from pyspark.sql import functions as F

from quarry.plans import model_jobs as mj


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tree_predictions_are_reproducible(wh):
    # variant B: no Word2Vec stage (its multi-partition training is not bit-stable)
    a = _rows(mj.decision_tree(wh, "B"))
    b = _rows(mj.decision_tree(wh, "B"))
    assert a == b and len(a) > 0
    assert {r[2] for r in a} <= {0.0, 1.0}


def test_split_sizes_are_reproducible_with_word2vec(wh):
    a = mj.decision_tree(wh, "A")
    assert a.count() == mj.decision_tree(wh, "B").count()


def test_kmeans_is_reproducible_and_uses_k_clusters(wh):
    a = _rows(mj.kmeans(wh))
    b = _rows(mj.kmeans(wh))
    assert a == b
    assert {r[1] for r in a} <= set(range(mj.KMEANS_K))


def test_hiring_scores_are_metrics(wh):
    scores = mj.hiring_model_indexed(wh).collect()
    assert {r.model for r in scores} == {"decision_tree", "random_forest"}
    for r in scores:
        assert 0.0 <= r.weighted_f1 <= 1.0 and 0.0 <= r.accuracy <= 1.0
        assert abs(r.f1_error - (1 - r.weighted_f1)) < 1e-9


def test_cluster_profile_covers_every_row(wh):
    prof = mj.cluster_profile(wh)
    total = prof.filter(F.col("column_name") == "S_years").agg(F.sum("count")).first()[0]
    assert total == mj.model_input(wh).count()
