"""Fits do not depend on how files are split into tasks."""

import pytest

from quarry.plans import model_jobs


def _under(spark, setting, value, run):
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        return sorted(map(tuple, run().collect()), key=str)
    finally:
        spark.conf.set(setting, before)


@pytest.mark.parametrize("job", [lambda wh: model_jobs.decision_tree(wh, "B"), model_jobs.kmeans], ids=["tree", "kmeans"])
def test_same_rows_under_two_split_sizes(spark, wh, job):
    runs = [_under(spark, "spark.sql.files.maxPartitionBytes", size, lambda: job(wh)) for size in ("134217728", "16384")]
    assert runs[0] == runs[1]
