"""Small literal inputs (fixtures, parameter tables). Never for table-sized data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MAX_LITERAL_ROWS = 10_000


def from_rows(
    spark: SparkSession,
    rows: Sequence[tuple],
    schema: StructType | str | Sequence[str],
    max_rows: int = MAX_LITERAL_ROWS,
) -> DataFrame:
    """Rows held by the driver become a DataFrame; refuses more than ``max_rows``."""
    rows = list(rows)
    if len(rows) > max_rows:
        raise ValueError(f"{len(rows)} literal rows exceed {max_rows}; write them to storage instead")
    return spark.createDataFrame(rows, schema)


def from_list(
    spark: SparkSession, values: Iterable, column: str = "value", max_rows: int = MAX_LITERAL_ROWS
) -> DataFrame:
    """A driver list as a one-column DataFrame (the DataFrame form of ``parallelize``)."""
    return from_rows(spark, [(v,) for v in values], [column], max_rows)
