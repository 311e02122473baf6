"""Projections, filters, grouped counts, summaries, distinct and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import r6


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols)


def project_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select ``source -> alias`` pairs, in mapping order."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def derive(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add or replace one column."""
    return df.withColumn(name, expr)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def where_sql(df: DataFrame, condition: str) -> DataFrame:
    """Filter by SQL text, e.g. ``"p_brand = 'Brand#13'"``."""
    return df.where(condition)


def count_value(df: DataFrame, column: str, value, out: str = "n") -> DataFrame:
    """How many rows hold ``value``. Pure: calling it twice gives the same answer."""
    return df.filter(F.col(column) == F.lit(value)).agg(F.count(F.lit(1)).alias(out))


def count_value_ci(df: DataFrame, column: str, value: str, out: str = "n") -> DataFrame:
    """Case-insensitive :func:`count_value` (lower both sides)."""
    return df.filter(F.lower(F.col(column)) == F.lit(value.lower())).agg(F.count(F.lit(1)).alias(out))


def group_count(df: DataFrame, *keys: str | Column, out: str = "count") -> DataFrame:
    """Rows per group (``groupBy().count()``); partial counts are combined map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def group_count_nonnull(df: DataFrame, keys: Sequence[str | Column], counted: str, out: str) -> DataFrame:
    """``count(col)`` per group: NULLs in ``counted`` are not counted."""
    return df.groupBy(*keys).agg(F.count(F.col(counted)).alias(out))


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def distinct_of(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols).distinct()


_STATS = ("count", "mean", "stddev", "min", "max")


def _stat_exprs(c: str, prefix: str) -> list[Column]:
    x = F.col(c).cast("double")
    return [
        F.count(x).alias(f"{prefix}count"),
        F.avg(x).alias(f"{prefix}mean"),
        F.stddev_samp(x).alias(f"{prefix}stddev"),
        F.min(x).alias(f"{prefix}min"),
        F.max(x).alias(f"{prefix}max"),
    ]


def _unpivot_stats(wide: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Wide (one stat set per column) -> long (one row per column)."""
    structs = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(f"_{i}_{s}").alias(s) for s in _STATS],
        )
        for i, c in enumerate(cols)
    ]
    long = wide.select(*keys, F.explode(F.array(*structs)).alias("_s"))
    return long.select(
        *keys,
        F.col("_s.column_name").alias("column_name"),
        F.col("_s.count").alias("count"),
        r6(F.col("_s.mean")).alias("mean"),
        r6(F.col("_s.stddev")).alias("stddev"),
        F.col("_s.min").alias("min"),
        F.col("_s.max").alias("max"),
    )


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample stddev, min, max per column as typed values.

    ``DataFrame.describe`` returns strings; this returns one row per column,
    computed in a single aggregation pass.
    """
    exprs = [e for i, c in enumerate(cols) for e in _stat_exprs(c, f"_{i}_")]
    return _unpivot_stats(df.agg(*exprs), [], cols)


def summary_by_group(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """:func:`numeric_summary` for every value of ``group`` in one ``groupBy`` pass
    (instead of one filter and scan per group)."""
    exprs = [e for i, c in enumerate(cols) for e in _stat_exprs(c, f"_{i}_")]
    return _unpivot_stats(df.groupBy(group).agg(*exprs), [group], cols)


def sorted_limit(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``n`` rows under a total order (``TakeOrderedAndProject``: a per-partition
    top-n and a merge of n rows per partition, no full sort)."""
    return df.orderBy(*order).limit(n)


def top_k_by_count(counts: DataFrame, key: str, count_col: str, k: int) -> DataFrame:
    """The ``k`` most frequent keys; ties broken by key so the cut is deterministic."""
    return counts.orderBy(F.col(count_col).desc(), F.col(key).asc()).limit(k)
