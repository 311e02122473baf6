"""Seeded random draws that depend on a row's content alone: splits and bootstrap weights.

A draw is a counter-based generator: a whole number below 2^48 from the MD5 of a seed and the
values that name the draw. It does not depend on partitions, on the order of rows or on the run,
and SQL can repeat it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DRAW_SPACE = 1 << 48
PIECE_ROWS = 1 << 14


def _digits(seed: int, *parts: Column) -> Column:
    """The 12 hexadecimal digits of a draw; null parts count as a value of their own."""
    named = [F.coalesce(F.concat(F.octet_length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-")) for p in parts]
    return F.substring(F.md5(F.concat(F.lit(f"{seed};"), *named)), 1, 12)


def draw(seed: int, *parts: Column) -> Column:
    """A whole number in ``[0, 2^48)`` for the seed and the parts; null parts count as a value of their own."""
    return F.conv(_digits(seed, *parts), 16, 10).cast("bigint")


def fresh(name: str, columns: Sequence[str]) -> str:
    """``name`` with as many underscores before it as keep it apart from ``columns`` (names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def split_bounds(fractions: Sequence[float]) -> list[int]:
    """Upper bounds of the parts of ``[0, 2^48)``; the last part takes the rest."""
    if any(f < 0 for f in fractions) or not sum(fractions) > 0:
        raise ValueError("fractions must not be negative and not all 0")
    total, upto, bounds = sum(fractions), 0.0, []
    for f in fractions[:-1]:
        upto += f / total
        bounds.append(math.ceil(upto * DRAW_SPACE))
    return bounds


def random_split(df: DataFrame, fractions: Sequence[float], names: Sequence[str], seed: int, out: str = "split") -> DataFrame:
    """``df`` with the name of a part per row, drawn independently for every row with the given chances.

    A row's draw is named by all its columns and, since equal rows are rows of their own, by its number among
    its equals. Equal rows are counted first (combined map-side) and then written out again by
    their count, a very frequent row in pieces of ``PIECE_ROWS`` that are dealt to the tasks. Columns of map type
    cannot be grouped and are refused by Spark.
    """
    if len(fractions) != len(names):
        raise ValueError("as many names as fractions")
    cols = df.columns
    n, piece, number = (fresh(x, cols + [out]) for x in ("n", "piece", "number"))
    counted = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias(n))
    few = counted.where(F.col(n) <= PIECE_ROWS).withColumn(number, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)))
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / PIECE_ROWS))
    many = counted.where(F.col(n) > PIECE_ROWS).withColumn(piece, F.explode(pieces)).repartition(n, piece, *[F.col(f"`{c}`") for c in cols])
    start = F.col(piece) * PIECE_ROWS
    many = many.withColumn(number, F.explode(F.sequence(start, F.least(start + PIECE_ROWS, F.col(n)) - 1))).drop(piece)
    at = draw(seed, *[F.col(f"`{c}`") for c in cols], F.col(number))
    part = F.lit(names[-1])
    for bound, name in reversed(list(zip(split_bounds(fractions), names))):
        part = F.when(at < bound, F.lit(name)).otherwise(part)
    return few.unionByName(many).select(*[F.col(f"`{c}`") for c in cols], part.alias(out))


def poisson_bounds() -> list[int]:
    """Bounds ``b`` so that the number of bounds at or below a draw has the Poisson distribution of mean 1."""
    bounds, share, upto = [], math.exp(-1), 0.0
    for k in range(1, 17):
        upto += share
        bounds.append(math.ceil(upto * DRAW_SPACE))
        share /= k
    return bounds


def bag_weight(seed: int, tree: int | Column, key: str) -> Column:
    """How often the row of ``key`` is in the bootstrap sample of ``tree``: 0, 1, 2, ..., mean 1."""
    at = _digits(seed, tree if isinstance(tree, Column) else F.lit(tree), F.col(key))

    def count(digits: Column) -> Column:  # digits of equal number compare as the numbers do
        bounds = [b for b in poisson_bounds() if b < DRAW_SPACE]
        held = F.when(digits < f"{bounds[0]:012x}", 0)
        for n, b in enumerate(bounds[1:], 1):
            held = held.when(digits < f"{b:012x}", n)
        return held.otherwise(len(bounds))

    return F.transform(F.array(at), count)[0].cast("double")  # so the draw is computed once, not per bound
