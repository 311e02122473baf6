"""Sources: the parquet test tables, CSV / JSON / text / JDBC readers, views."""

from quarry.sources.catalog import register_views, schema_report
from quarry.sources.files import (
    read_csv,
    read_json,
    read_text,
    write_csv,
    write_json,
    write_text,
)
from quarry.sources.jdbc import jdbc_options, read_jdbc
from quarry.sources.literal import from_list, from_rows
from quarry.sources.tables import TABLE_NAMES, Warehouse, read_table

__all__ = [
    "TABLE_NAMES",
    "Warehouse",
    "from_list",
    "from_rows",
    "jdbc_options",
    "read_csv",
    "read_jdbc",
    "read_json",
    "read_table",
    "read_text",
    "register_views",
    "schema_report",
    "write_csv",
    "write_json",
    "write_text",
]
