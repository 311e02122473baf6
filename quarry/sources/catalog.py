"""Views and schema reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

SCHEMA_REPORT_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("position", IntegerType(), False),
        StructField("column_name", StringType(), False),
        StructField("data_type", StringType(), False),
        StructField("nullable", StringType(), False),
    ]
)


def register_views(frames: Mapping[str, DataFrame]) -> list[str]:
    """Register each frame as a temp view (view names ignore case in Spark SQL)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def schema_report(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, nullable) per column: ``printSchema`` as data.

    Reads only schema metadata; its size is the number of columns.
    """
    rows = [
        (name, pos, field.name, field.dataType.simpleString(), str(field.nullable).lower())
        for name, df in frames.items()
        for pos, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, SCHEMA_REPORT_SCHEMA)
