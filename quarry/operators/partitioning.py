"""Input spread for CPU-heavy per-row work (tokenising, regex counts)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SPREAD_SETTING = "spark.quarry.inputSpread"


def spread(df: DataFrame, keys: Sequence[str], partitions: int | None) -> DataFrame:
    """Rows dealt by ``keys`` to ``partitions`` tasks, or ``df`` itself for ``None``.

    Only for inputs that one task would read (a file of one parquet row group): it moves the
    raw rows once. The caller names the number; nothing is derived from the cluster.
    """
    return df if partitions is None else df.repartition(partitions, *keys)


def spread_setting(spark: SparkSession) -> int | None:
    """The number of partitions the session asks for (``spark.quarry.inputSpread``), by default none."""
    value = spark.conf.get(SPREAD_SETTING, None)
    return int(value) if value else None
