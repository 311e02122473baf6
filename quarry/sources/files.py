"""CSV, JSON-lines and text readers and writers.

Readers take an explicit schema; schema inference stays an opt-in flag because
it costs an extra pass over the input and one dirty value turns a numeric
column into a string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    infer_schema: bool = False,
) -> DataFrame:
    """CSV scan. Blank fields and ``""`` read as NULL; quoted separators are kept."""
    reader = spark.read.option("sep", sep).option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON-lines scan (one object per line)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text scan: one row per line in a single string column ``value``."""
    return spark.read.text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> str:
    df.write.mode("errorifexists").option("header", str(header).lower()).option("sep", sep).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").json(path)
    return path


def write_text(df: DataFrame, path: str) -> str:
    """``df`` must have exactly one string column."""
    df.write.mode("errorifexists").text(path)
    return path
