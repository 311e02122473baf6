"""Key and NOT NULL checks: declared constraints re-expressed as queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Primary-key check: every key value held by more than one row, with its count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key check: child rows whose non-NULL key has no parent (left anti join)."""
    parent_keys = parent.select(F.col(parent_key).alias("_pk"))
    return child.filter(F.col(child_key).isNotNull()).join(
        parent_keys, F.col(child_key) == F.col("_pk"), "left_anti"
    )


def orphan_count(
    name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """One row ``(constraint_name, n_checked, n_orphans)`` for a foreign key."""
    return orphan_count_multi(name, child, [child_key], parent, [parent_key])


def orphan_count_multi(
    name: str,
    child: DataFrame,
    child_keys: Sequence[str],
    parent: DataFrame,
    parent_keys: Sequence[str],
) -> DataFrame:
    """Foreign-key check on a (possibly composite) key, counted in one pass.

    Child rows with a NULL in the key are not checked (a NULL reference is
    allowed). Both sides are aggregated per key before the join: child rows are
    counted per key (a hot key collapses map-side) and parent keys are
    de-duplicated, so the join meets at most one row per key on each side and
    both inputs already share the key partitioning.
    """
    ck = [F.col(c).alias(f"_c{i}") for i, c in enumerate(child_keys)]
    pk = [F.col(c).alias(f"_c{i}") for i, c in enumerate(parent_keys)]
    names = [f"_c{i}" for i in range(len(child_keys))]
    checked = child.select(*ck).dropna(subset=names).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    hits = parent.select(*pk).distinct().withColumn("_hit", F.lit(1))
    flagged = checked.join(hits, names, "left")
    return flagged.agg(
        F.lit(name).alias("constraint_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_checked"),
        F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("n_orphans"),
    )


def null_counts(df: DataFrame, table_name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """NOT NULL check: ``(table_name, column_name, n_null)`` per column, one scan."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"_{i}").alias("n")) for i, c in enumerate(cols)])
    return wide.select(F.explode(pairs).alias("_p")).select(
        F.lit(table_name).alias("table_name"),
        F.col("_p.c").alias("column_name"),
        F.col("_p.n").alias("n_null"),
    )
