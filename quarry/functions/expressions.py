"""Scalar column expressions.

All of these are compositions of built-in Spark functions, so they stay inside
whole-stage codegen and Catalyst can push filters built on them.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_double(c: ColumnOrName) -> Column:
    """Text label to double; text that is not a number (``'No'``, blank) gives NULL.

    Spark 4 runs with ANSI casts, under which ``'No' = 1`` raises. ``try_cast``
    keeps the old meaning: a bad value turns NULL and drops out of comparisons.
    """
    return _col(c).try_cast("double")


def not_blank(c: ColumnOrName) -> Column:
    """``c != ''``; NULL compares to NULL and so is dropped by a filter as well."""
    return _col(c) != F.lit("")


def month_of(c: ColumnOrName) -> Column:
    return F.month(_col(c)).cast("bigint")


def year_of(c: ColumnOrName) -> Column:
    return F.year(_col(c)).cast("bigint")


def lower_text(c: ColumnOrName) -> Column:
    return F.lower(_col(c))


def split_keep_empty(c: ColumnOrName, separator: str) -> Column:
    """Split on a literal separator, keeping every empty piece (Python ``str.split(sep)``)."""
    return F.split(_col(c), re.escape(separator), -1)


def java_space_split(c: ColumnOrName) -> Column:
    """Split on one space the way ``java.util.regex.Pattern.split`` does.

    Trailing empty pieces are dropped, so a non-empty line of spaces gives no
    token, while an empty line gives one empty token.
    """
    c = _col(c)
    trimmed = F.rtrim(c, F.lit(" "))
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " ", -1))
    )


def whitespace_tokens(c: ColumnOrName) -> Column:
    """``pyspark.ml.feature.Tokenizer``: lower case, split on one whitespace char.

    Inner and leading empty tokens are kept; trailing ones are dropped (Java split).
    """
    lowered = F.lower(_col(c))
    trimmed = F.regexp_replace(lowered, r"\s+$", "")
    return (
        F.when(lowered == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, r"\s", -1))
    )


def regex_tokens(c: ColumnOrName, pattern: str = r"\W", min_length: int = 1, lowercase: bool = True) -> Column:
    """``pyspark.ml.feature.RegexTokenizer`` with ``gaps=True``: split on ``pattern``
    and keep tokens of at least ``min_length`` characters."""
    text = F.lower(_col(c)) if lowercase else _col(c)
    return F.filter(F.split(text, pattern, -1), lambda t: F.length(t) >= min_length)


def pattern_count(c: ColumnOrName, pattern: str) -> Column:
    """Non-overlapping occurrences of a regular expression (case-sensitive)."""
    return F.regexp_count(_col(c), F.lit(pattern)).cast("bigint")


def strip_brackets(c: ColumnOrName) -> Column:
    """Remove a leading ``[[[`` and a trailing ``]]]``."""
    c = _col(c)
    inner = F.when(F.startswith(c, F.lit("[[[")), F.substring(c, F.lit(4), F.length(c))).otherwise(c)
    return F.when(F.endswith(inner, F.lit("]]]")), F.left(inner, F.length(inner) - 3)).otherwise(inner)


def r6(c: ColumnOrName) -> Column:
    """Round to 6 decimals and fold -0.0 into 0.0 (for engine-independent output)."""
    rounded = F.round(_col(c), 6)
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)


# Fixed values of the multiplicative split hash (Knuth's golden-ratio constant
# modulo 2^32); the SQL oracle uses the same numbers.
HASH_MULTIPLIER = 2654435761
HASH_SPACE = 4294967296


def unit_hash(key: ColumnOrName) -> Column:
    """``(key * 2654435761) mod 2^32`` for any BIGINT key, without overflow.

    The key is reduced mod 2^32 and split into 16-bit halves so that every
    intermediate product stays below 2^49. The value depends only on the key,
    never on partitioning, so splits built on it are reproducible.
    """
    a = F.pmod(_col(key).cast("bigint"), F.lit(HASH_SPACE))
    hi = F.shiftright(a, 16)
    lo = a.bitwiseAND(F.lit(65535))
    high_part = F.pmod(hi * F.lit(HASH_MULTIPLIER), F.lit(65536)) * F.lit(65536)
    return F.pmod(high_part + lo * F.lit(HASH_MULTIPLIER), F.lit(HASH_SPACE))


def hash_fraction_threshold(fraction: float) -> int:
    """Integer bound t with ``unit_hash < t`` holding for ``fraction`` of the hash space."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    return int(math.ceil(fraction * HASH_SPACE))
