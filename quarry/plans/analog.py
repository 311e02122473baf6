"""The client-hiring warehouse, played by the driver's TPC-H-like tables.

Mapping (one frame per warehouse table; all lazy):

* hires          <- orders:   id = o_orderkey, client_id = o_custkey,
                               hired = text label from o_orderstatus
                               (F -> '1', O -> '0', P -> 'No': a dirty text label),
                               job_function = o_orderpriority
* activities     <- orders:   id, create_date = o_orderdate
* bio            <- customer x nation: client_id, service_branch = c_mktsegment,
                               service_rank = n_name, client_value = c_acctbal
* communication  <- events:   id = event_id, client_id = user_id,
                               contact_method = event_type
* fact           <- lineitem: years_in_service = l_quantity,
                               reg_after_years = (l_discount - l_tax) * 100,
                               numeric / 0-1 inputs from discount, tax, price and
                               return flag
* client star    <- lineitem -> orders -> customer -> nation -> region (+ part
                    for the bracketed education text), the model input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import not_blank, strip_brackets, tolerant_double
from quarry.operators.joins import hot_keys, salted_join
from quarry.sources.tables import Warehouse

# The label text each order status stands for.
STATUS_TO_LABEL = {"F": "1", "O": "0", "P": "No"}

# Open ranges of the model-input filter (years 10..40 exclusive,
# after-service years -32..53 exclusive) and the label values it rejects.
YEARS_RANGE = (10, 40)
AFTER_YEARS_RANGE = (-32, 53)


def hired_label(status: Column) -> Column:
    expr = None
    for code, label in STATUS_TO_LABEL.items():
        expr = (F.when(status == code, F.lit(label)) if expr is None else expr.when(status == code, F.lit(label)))
    return expr


def statuses_with_label_value(value: float) -> list[str]:
    """Order statuses whose text label parses to ``value`` (derived from the fixed map)."""
    out = []
    for code, label in STATUS_TO_LABEL.items():
        try:
            if float(label) == value:
                out.append(code)
        except ValueError:
            continue
    return out


def hires_with_label(wh: Warehouse, value: float) -> DataFrame:
    """Hiring rows whose dirty text label equals ``value`` as a number.

    The label test itself (``try_cast(hired) = value``) stays, and the equivalent
    test on the source column, ``o_orderstatus IN (...)``, is added in front: a
    CASE-built label cannot be pushed into the scan, the IN list can (parquet
    row-group skipping by statistics).
    """
    codes = statuses_with_label_value(value)
    source = wh.orders.where(F.col("o_orderstatus").isin(codes))
    return hires_of(source).where(tolerant_double("hired") == F.lit(value))


def hires(wh: Warehouse) -> DataFrame:
    return hires_of(wh.orders)


def hires_of(o: DataFrame) -> DataFrame:
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("client_id"),
        hired_label(F.col("o_orderstatus")).alias("hired"),
        F.col("o_orderpriority").alias("job_function"),
    )


def activities(wh: Warehouse) -> DataFrame:
    return wh.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("create_date"))


def bio(wh: Warehouse) -> DataFrame:
    c = wh.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    n = wh.nation.select("n_nationkey", "n_name")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("client_id"),
        F.col("c_mktsegment").alias("service_branch"),
        F.col("n_name").alias("service_rank"),
        F.col("c_acctbal").alias("client_value"),
    )


def communication(wh: Warehouse) -> DataFrame:
    return wh.events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("client_id"),
        F.col("event_type").alias("contact_method"),
    )


def education_text(p_name: Column) -> Column:
    """The bracketed list form ``[[[a, b]]]`` of a part name."""
    return F.concat(F.lit("[[["), F.replace(p_name, F.lit(" "), F.lit(", ")), F.lit("]]]"))


def statuses_with_label(keep) -> list[str]:
    """Order statuses whose label text satisfies ``keep`` (derived from the fixed map)."""
    return [code for code, label in STATUS_TO_LABEL.items() if keep(label)]


def client_star(
    wh: Warehouse,
    rows_per_salt: int | None = None,
    statuses: list[str] | None = None,
) -> DataFrame:
    """Fact lineitem joined to its dimensions, all analog columns, no filter.

    Join order is chosen for shuffle volume: the order-side dimensions
    (customer, then nation and region) are joined
    to ``orders`` first, which is a quarter of the fact's size, so the
    fact-sized intermediate is shuffled only twice (on the order key, then on
    the part key) instead of three times. AQE splits skewed keys in both joins;
    with ``rows_per_salt`` set, keys of more fact rows than that are also salted
    explicitly (``joins.salted_join``), which does not depend on AQE.
    Catalyst prunes every column the caller does not select. ``statuses``
    restricts the orders scan to those status codes (a pushed-down IN filter):
    callers pass the codes their label filter keeps, derived from the fixed map,
    and keep the label filter itself as well.
    """
    li = wh.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_extendedprice", "l_returnflag", "l_linestatus",
    )
    o = wh.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    if statuses is not None:
        o = o.where(F.col("o_orderstatus").isin(list(statuses)))
    c = wh.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    p = wh.part.select("p_partkey", "p_name")
    cust = c.join(wh.nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    cust = cust.join(wh.region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    order_side = o.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    if rows_per_salt is None:
        star = li.join(order_side, F.col("l_orderkey") == F.col("o_orderkey")).join(
            p, F.col("l_partkey") == F.col("p_partkey")
        )
    else:
        by_order = salted_join(li, order_side, "l_orderkey", "o_orderkey", hot_keys(li, "l_orderkey", rows_per_salt))
        star = salted_join(by_order, p, "l_partkey", "p_partkey", hot_keys(li, "l_partkey", rows_per_salt))
    return star.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").alias("S_years"),
        ((F.col("l_discount") - F.col("l_tax")) * 100).alias("R_years"),
        F.col("l_discount").alias("Resume_Tips"),
        F.col("l_tax").alias("Resume_OnFile"),
        F.col("c_acctbal").alias("Client"),
        F.col("r_name").alias("Client_Type"),
        F.col("n_name").alias("Service_R"),
        F.col("c_mktsegment").alias("Service_B"),
        F.col("o_totalprice").alias("Confirmed_hire"),
        F.col("o_orderpriority").alias("Com_Method"),
        F.col("l_extendedprice").alias("responsive"),
        F.col("l_linestatus").alias("active"),
        (F.col("l_returnflag") == "R").cast("int").alias("Created_Linkedin"),
        education_text(F.col("p_name")).alias("Educ"),
        hired_label(F.col("o_orderstatus")).alias("hired"),
        F.col("p_name").alias("Occupation"),
    )


def model_filter(star: DataFrame) -> DataFrame:
    """The model-input conjunction: no blank category, open ranges on the two
    year columns, and a label that is neither blank, 'No' nor 3."""
    label = tolerant_double("hired")
    cond = (
        not_blank("Client_Type")
        & not_blank("Service_B")
        & not_blank("Service_R")
        & not_blank("Com_Method")
        & (F.col("S_years") < YEARS_RANGE[1])
        & (F.col("S_years") > YEARS_RANGE[0])
        & (F.col("R_years") > AFTER_YEARS_RANGE[0])
        & (F.col("R_years") < AFTER_YEARS_RANGE[1])
        & not_blank("active")
        & not_blank("Educ")
        & not_blank("hired")
        & (F.col("hired") != "No")
        & (label != 3)
    )
    return star.where(cond)


def _model_label_ok(label: str) -> bool:
    """The label test of ``model_filter`` applied to one fixed label text."""
    if label in ("", "No"):
        return False
    try:
        return float(label) != 3
    except ValueError:
        return False


def client_features(wh: Warehouse, rows_per_salt: int | None = None) -> DataFrame:
    """The filtered star join: the model input of the hiring jobs. The statuses
    whose label passes the filter are also pushed into the orders scan."""
    return model_filter(client_star(wh, rows_per_salt, statuses_with_label(_model_label_ok)))


SALT_ROWS = 20


def client_features_salted(wh: Warehouse) -> DataFrame:
    """J4 with hot keys salted: every order or part of more than 20 fact rows counts as hot here,
    so that tables of any size have some."""
    return client_features(wh, SALT_ROWS)


def education_tokens(c: Column) -> Column:
    """``[[[a, b]]]`` -> ``['a', 'b']``."""
    return F.split(strip_brackets(c), ", ", -1)


def warehouse_views(wh: Warehouse, label: float | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The analog tables by name, each built when called. With ``label`` the hires are those of that label, tested on the
    label and, pushed into the scan, on the status it comes from."""
    return {
        "hires": lambda: hires(wh) if label is None else hires_with_label(wh, label),
        "bio": lambda: bio(wh),
        "communication": lambda: communication(wh),
        "activities": lambda: activities(wh),
        "star": lambda: client_star(wh, statuses=None if label is None else statuses_with_label_value(label)),
    }
