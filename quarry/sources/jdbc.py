"""JDBC table scan.

A plain JDBC read runs in one task. Given a numeric partition column and its
bounds, Spark splits the scan into ``num_partitions`` range queries that run in
parallel; the bounds only set the stride, rows outside them are still read.
Connection details are always parameters, never defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
        if upper_bound <= lower_bound:
            raise ValueError("upper_bound must exceed lower_bound")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """``spark.read.format('jdbc')`` with the options of :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
