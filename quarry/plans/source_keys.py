"""Source round trips (S1, S2, S4, S5): Spark writes a test table in the format,
then scans it back with an explicit schema. Files go below the shared
checkpoint folder (``spark.checkpoint.dir``), one fresh folder per call."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from quarry.plans import analog
from quarry.session import scratch_path
from quarry.sources import files
from quarry.sources.tables import Warehouse

CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType()),
    StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()),
    StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType()),
])

EDUCATION_SCHEMA = StructType([
    StructField("p_partkey", LongType()),
    StructField("educ_raw", StringType()),
    StructField("p_size", IntegerType()),
])

PAGE_SCHEMA = StructType([
    StructField("page_id", LongType()),
    StructField("url", StringType()),
    StructField("html", StringType()),
])


def scan_csv(wh: Warehouse) -> DataFrame:
    """CSV with a header line, read with a given schema."""
    path = files.write_csv(wh.customer, scratch_path(wh.spark, "csv"), header=True)
    return files.read_csv(wh.spark, path, schema=CUSTOMER_SCHEMA, header=True)


def scan_csv_headerless(wh: Warehouse) -> DataFrame:
    """Headerless CSV whose text field holds quoted commas."""
    src = wh.part.select("p_partkey", analog.education_text(F.col("p_name")).alias("educ_raw"), "p_size")
    path = files.write_csv(src, scratch_path(wh.spark, "csv-noheader"), header=False)
    return files.read_csv(wh.spark, path, schema=EDUCATION_SCHEMA, header=False)


def scan_text(wh: Warehouse) -> DataFrame:
    """One line per row in ``value``."""
    path = files.write_text(wh.part.select("p_name"), scratch_path(wh.spark, "text"))
    return files.read_text(wh.spark, path)


def scan_json(wh: Warehouse) -> DataFrame:
    """JSON lines (HTML bodies with quotes and newlines escaped)."""
    path = files.write_json(wh.pages.select("page_id", "url", "html"), scratch_path(wh.spark, "json"))
    return files.read_json(wh.spark, path, schema=PAGE_SCHEMA)
