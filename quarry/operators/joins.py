"""Join helpers: eager (pre-join) aggregation, hot-key salting.

A side is hinted for broadcast only when its size is bounded by construction (a
top-k result). Every other join is left to Spark, which goes by the bytes of the
files and, with AQE on, of the shuffled sides, and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.sampling import fresh


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def count_through_dimension(
    fact: DataFrame,
    fact_key: str,
    counted: str,
    dim: DataFrame,
    dim_key: str,
    group_cols: Sequence[str],
    out: str,
) -> DataFrame:
    """``SELECT dim.g, count(fact.counted) FROM fact JOIN dim ON key GROUP BY dim.g``.

    The fact is first counted per join key (partial + final aggregate), so a hot
    key with a third of all fact rows collapses to one row per map task before
    any shuffle, and the join then sees one row per key on each side. The
    aggregate is already hash-partitioned on the key, so only the dimension is
    shuffled for the join.
    """
    per_key = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.col(counted)).alias("_n"))
    dim_side = dim.select(F.col(dim_key).alias("_k"), *group_cols)
    return per_key.join(dim_side, "_k").groupBy(*group_cols).agg(F.sum("_n").cast("bigint").alias(out))


def count_many_to_many(
    left: DataFrame,
    left_key: str,
    left_counted: str,
    group_cols: Sequence[str],
    right: DataFrame,
    right_key: str,
    out: str,
) -> DataFrame:
    """``count(left.counted)`` per ``left`` group over an m:n join with ``right``.

    Equals counting the rows of the m:n join, without building it: each side is
    aggregated per join key first (``n_left`` per key and group, ``n_right`` per
    key, rows whatever their columns hold), the two aggregates are joined on the key, and ``n_left * n_right`` is
    summed per group. No pair of rows is ever materialised.
    """
    l_agg = left.groupBy(F.col(left_key).alias("_k"), *group_cols).agg(F.count(F.col(left_counted)).alias("_nl"))
    r_agg = right.groupBy(F.col(right_key).alias("_k")).agg(F.count(F.lit(1)).alias("_nr"))
    return (
        l_agg.join(r_agg, "_k")
        .groupBy(*group_cols)
        .agg(F.sum(F.col("_nl") * F.col("_nr")).cast("bigint").alias(out))
    )


MAX_SALTS = 4096


def hot_keys(fact: DataFrame, key: str, rows_per_salt: int) -> DataFrame:
    """``hot_key, salts``: the keys of more than ``rows_per_salt`` fact rows and how many tasks each should be dealt to.

    One pass over the key column alone (partial + final count). The table has fewer than
    rows / rows_per_salt rows; it is joined, never collected.
    """
    counts = fact.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    salts = F.least(F.ceil(F.col("n") / rows_per_salt), F.lit(MAX_SALTS)).cast("int").alias("salts")
    return counts.where((F.col("n") > rows_per_salt) & F.col("hot_key").isNotNull()).select("hot_key", salts)


def salted_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """Equi-join that spreads each hot key (``hot_keys``) over as many tasks as it has salts.

    Fact rows of a hot key get a salt from a hash of their content
    (deterministic, so a retried task routes every row the same way); the
    dimension rows of that key are replicated once per salt. Other keys keep
    salt 0 and join unchanged. The result equals the plain join; only the hot keys' dimension
    rows are copied. Fact rows equal in all columns share a salt.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError("salting replicates dimension rows: only inner and left-side joins stay exact")
    every = [*fact.columns, *dim.columns]
    names = [fresh(n, every) for n in ("hot_key", "salts", "salt", "salt_of_dim")]
    hot_key, salts, salt, dim_salt = names
    table = hot.toDF(hot_key, salts)
    some = F.coalesce(F.col(salts), F.lit(1))
    content = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
    f = fact.join(table, F.col(fact_key) == F.col(hot_key), "left").withColumn(salt, F.pmod(content, some).cast("int")).drop(hot_key, salts)
    d = dim.join(table, F.col(dim_key) == F.col(hot_key), "left").withColumn(dim_salt, F.explode(F.sequence(F.lit(0), some - 1))).drop(hot_key, salts)
    return f.join(d, (F.col(fact_key) == F.col(dim_key)) & (F.col(salt) == F.col(dim_salt)), how).drop(salt, dim_salt)
