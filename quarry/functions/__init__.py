"""Column expressions built only from ``pyspark.sql.functions`` (JVM side, codegen)."""

from quarry.functions.expressions import (
    HASH_SPACE,
    hash_fraction_threshold,
    java_space_split,
    lower_text,
    month_of,
    not_blank,
    pattern_count,
    r6,
    regex_tokens,
    split_keep_empty,
    strip_brackets,
    tolerant_double,
    unit_hash,
    whitespace_tokens,
    year_of,
)

__all__ = [
    "HASH_SPACE",
    "hash_fraction_threshold",
    "java_space_split",
    "lower_text",
    "month_of",
    "not_blank",
    "pattern_count",
    "r6",
    "regex_tokens",
    "split_keep_empty",
    "strip_brackets",
    "tolerant_double",
    "unit_hash",
    "whitespace_tokens",
    "year_of",
]
