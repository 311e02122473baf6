"""Single-operator keys over the whole test tables (P*, A*, O3, F4, F5, quality)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import not_blank, r6, strip_brackets, tolerant_double
from quarry.operators import quality
from quarry.operators import relational as rel
from quarry.plans import analog
from quarry.sources.tables import Warehouse

MODEL_NUMBERS = ["S_years", "R_years"]


def project_columns(wh: Warehouse) -> DataFrame:
    """A 3-column projection (the scan reads only these columns)."""
    return rel.project(wh.lineitem, "l_orderkey", "l_partkey", "l_quantity")


def derive_column(wh: Warehouse) -> DataFrame:
    """Add a computed column."""
    li = wh.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    out = rel.derive(li, "revenue", r6(F.col("l_extendedprice") * (1 - F.col("l_discount"))))
    return out.select("l_orderkey", "l_linenumber", "revenue")


def drop_columns(wh: Warehouse) -> DataFrame:
    """P4."""
    return rel.drop_columns(wh.customer, "c_name", "c_acctbal")


def try_cast_label(wh: Warehouse) -> DataFrame:
    """P5: the dirty text label and its tolerant double value."""
    h = analog.hires(wh)
    return h.select("id", "hired", tolerant_double("hired").alias("hired_value"))


def filter_eq(wh: Warehouse) -> DataFrame:
    """Equality filter by a column expression."""
    o = wh.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rel.filter_eq(o, "o_orderpriority", "1-URGENT").select("o_orderkey", "o_totalprice")


def filter_conjunction(wh: Warehouse) -> DataFrame:
    """Not-blank text, open ranges (one with a negative bound), one table."""
    li = wh.lineitem
    after = (F.col("l_discount") - F.col("l_tax")) * 100
    cond = (
        not_blank("l_returnflag")
        & not_blank("l_linestatus")
        & (F.col("l_quantity") > 10)
        & (F.col("l_quantity") < 40)
        & (after > -32)
        & (after < 53)
    )
    return li.where(cond).select("l_orderkey", "l_linenumber", "l_quantity", r6(after).alias("reg_after_years"))


def filter_numeric_text(wh: Warehouse) -> DataFrame:
    """A dirty text label compared with a number."""
    h = analog.hires(wh)
    return h.where(tolerant_double("hired") == 1).select("id", "hired")


def lower_case(wh: Warehouse) -> DataFrame:
    """Per-element map to lower case."""
    return wh.customer.select("c_custkey", F.lower("c_mktsegment").alias("segment_lower"))


def count_value(wh: Warehouse) -> DataFrame:
    """Rows equal to one value."""
    return rel.count_value(wh.events, "event_type", "purchase")


def count_value_ci(wh: Warehouse) -> DataFrame:
    """Rows equal to one value ignoring case."""
    return rel.count_value_ci(wh.customer, "c_mktsegment", "building")


def row_count(wh: Warehouse) -> DataFrame:
    """A3."""
    return rel.row_count(wh.lineitem)


def distinct_one(wh: Warehouse) -> DataFrame:
    """A5: the distinct labels of the model input."""
    f = analog.client_features(wh)
    return rel.distinct_of(f, tolerant_double("hired").alias("hired"))


def distinct_many(wh: Warehouse) -> DataFrame:
    """Distinct (branch, rank, label) of the model input."""
    f = analog.client_features(wh)
    return rel.distinct_of(f, "Service_B", "Service_R", tolerant_double("hired").alias("hired"))


def describe_columns(wh: Warehouse) -> DataFrame:
    """Typed count / mean / stddev / min / max per column."""
    return rel.numeric_summary(analog.client_features(wh), MODEL_NUMBERS)


def describe_by_group(wh: Warehouse) -> DataFrame:
    """The same summary per group, one pass."""
    return rel.summary_by_group(analog.client_features(wh), "Com_Method", MODEL_NUMBERS)


def limit_n(wh: Warehouse, n: int = 50) -> DataFrame:
    """First n rows under a total order (``show(50)``)."""
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    return rel.sorted_limit(wh.lineitem.select(*cols), n, cols)


def strip_brackets_key(wh: Warehouse) -> DataFrame:
    """strip ``[[[`` and ``]]]`` from the education text."""
    raw = analog.education_text(F.col("p_name"))
    return wh.part.select("p_partkey", raw.alias("educ_raw"), strip_brackets(raw).alias("educ"))


def split_list(wh: Warehouse) -> DataFrame:
    """split the stripped text on ``', '`` into (key, position, token)."""
    toks = analog.education_tokens(analog.education_text(F.col("p_name")))
    return wh.part.select("p_partkey", F.posexplode(toks).alias("pos", "token")).select(
        "p_partkey", F.col("pos").cast("bigint").alias("pos"), "token"
    )


# ---- quality checks --------------------------------------------------------


def pk_duplicates(wh: Warehouse) -> DataFrame:
    """A10: (l_orderkey, l_linenumber) values held by more than one line item."""
    return quality.duplicate_keys(wh.lineitem, ["l_orderkey", "l_linenumber"])


def fk_orphans(wh: Warehouse) -> DataFrame:
    """Orphan counts of three foreign keys that hold, and of one into a part of its table, which has orphans."""
    checks = [
        quality.orphan_count("lineitem.l_orderkey->orders", wh.lineitem, "l_orderkey", wh.orders, "o_orderkey"),
        quality.orphan_count("lineitem.l_partkey->part", wh.lineitem, "l_partkey", wh.part, "p_partkey"),
        quality.orphan_count("orders.o_custkey->customer", wh.orders, "o_custkey", wh.customer, "c_custkey"),
        quality.orphan_count(
            "lineitem.l_partkey->part of size over 25", wh.lineitem, "l_partkey", wh.part.where("p_size > 25"), "p_partkey"
        ),
    ]
    return reduce(DataFrame.unionByName, checks)


def self_fk_orphans(wh: Warehouse) -> DataFrame:
    """Each turn after the first must follow an existing turn of its conversation
    (the first turn has a NULL parent, which is allowed), and, which fails for some, a turn of a user."""
    conv = wh.conversations.select("conv_id", "turn", "role")
    child = conv.select(
        F.col("conv_id"),
        F.when(F.col("turn") > 0, F.col("turn") - 1).alias("parent_turn"),
    )
    check = lambda name, parent: quality.orphan_count_multi(
        f"conversations.prev_turn->{name}", child, ["conv_id", "parent_turn"], parent, ["conv_id", "turn"]
    )
    return check("conversations", conv).unionByName(check("turns of users", conv.where("role = 'user'")))


def not_null_violations(wh: Warehouse) -> DataFrame:
    """NULL count per column of three tables."""
    return reduce(
        DataFrame.unionByName,
        [
            quality.null_counts(wh.orders, "orders"),
            quality.null_counts(wh.customer, "customer"),
            quality.null_counts(wh.lineitem, "lineitem"),
        ],
    )
