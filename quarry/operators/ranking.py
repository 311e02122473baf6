"""Global positions of sorted rows without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.models import materialize

_LOCAL_BITS = (1 << 33) - 1


def with_position(df: DataFrame, order: Sequence[Column | str], out: str = "position") -> DataFrame:
    """``df`` with ``out``: the row's 0-based position in the global ``order``.

    Rows are range-partitioned and sorted, and written once: range boundaries come
    from a sample, so a recomputed stage could cut elsewhere. Each row keeps its task
    number and its place inside the task; a task's offset is the sum of the counts
    of the tasks before it (one row per task). ``order`` must be total for the
    positions to be the same on each run. Rows equal in ``order`` meet in one task.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    placed = materialize(
        ranged.withColumn("_task", F.spark_partition_id()).withColumn(
            "_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS))
        ),
        "positions",
    )
    per_task = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_task")  # one row per task of the sort
        .withColumn(out, (F.col("_offset") + F.col("_place")).cast("bigint"))
        .drop("_task", "_place", "_offset")
    )


def with_running_sum(df: DataFrame, order: Sequence[Column | str], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over all rows before the row in the global ``order``.

    As in ``with_position`` the rows are range-sorted and written; a task adds up its own rows, and the tasks
    before it add one number each. ``order`` must be total.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = materialize(
        df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_task", F.spark_partition_id()), "running"
    )
    per_task = placed.groupBy("_task").agg(F.sum(value).alias("_n"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_task").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(F.broadcast(offsets), "_task")  # one row per task of the sort
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_task", "_offset")
    )
