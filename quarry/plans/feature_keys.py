"""Feature and metric keys with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import tolerant_double
from quarry.operators import features as fx
from quarry.operators import metrics, text
from quarry.operators.partitioning import spread, spread_setting
from quarry.plans import analog
from quarry.sources.tables import Warehouse

SHAPE_COLS = ["len_body", "num_paragraphs", "num_links"]

# Fixed values of the reproducible splits: 0.7 / 0.3, and 0.1 then 0.65 / 0.35 of the rest.
SPLIT_FRACTIONS = (0.7, 0.3)
NESTED_SPLIT = (0.1, 0.65)

# The fixed prediction rule the metric keys score (SQL-expressible on purpose).
RULE_MIN_YEARS = 25


def _indexed_orders(wh: Warehouse) -> DataFrame:
    o = wh.orders.select("o_orderkey", "o_orderpriority")
    return fx.string_index(o, ["o_orderpriority"]).withColumnRenamed("o_orderpriorityIndex", "priority_index")


def string_index(wh: Warehouse) -> DataFrame:
    """M6: priority -> index, most frequent first, ties alphabetical."""
    return _indexed_orders(wh)


def _one_hot(wh: Warehouse, drop_last: bool) -> DataFrame:
    enc = fx.one_hot(_indexed_orders(wh), ["priority_index"], drop_last=drop_last)
    return fx.vector_long(enc, "priority_indexVec", ["o_orderkey"])


def one_hot_drop_last(wh: Warehouse) -> DataFrame:
    """M7: one-hot, the last category dropped, as (key, slot, value)."""
    return _one_hot(wh, True)


def one_hot_all(wh: Warehouse) -> DataFrame:
    """M7 with ``dropLast=False``."""
    return _one_hot(wh, False)


def shape_vectors(wh: Warehouse) -> DataFrame:
    pages = spread(wh.pages.select("page_id", "html"), ["page_id"], spread_setting(wh.spark))
    shape = text.text_shape(pages, "page_id", "html")
    return fx.assemble(shape, SHAPE_COLS, "shape")


def assemble(wh: Warehouse) -> DataFrame:
    """M9: three columns assembled into a vector (flattened for comparison)."""
    return fx.flatten_vector(shape_vectors(wh), "shape", [f"f_{c}" for c in SHAPE_COLS], ["page_id"])


def standard_scale(wh: Warehouse) -> DataFrame:
    """Each feature over its sample standard deviation."""
    scaled = fx.standard_scale(shape_vectors(wh), "shape", "scaled")
    return fx.flatten_vector(scaled, "scaled", [f"s_{c}" for c in SHAPE_COLS], ["page_id"])


def normalize_l1(wh: Warehouse) -> DataFrame:
    """Each vector over its L1 norm."""
    normed = fx.normalize(shape_vectors(wh), "shape", "normed", p=1.0)
    return fx.flatten_vector(normed, "normed", [f"n_{c}" for c in SHAPE_COLS], ["page_id"])


def hash_split(wh: Warehouse) -> DataFrame:
    """Reproducible 0.7 / 0.3 split of the orders."""
    return fx.hash_split(wh.orders.select("o_orderkey"), "o_orderkey", SPLIT_FRACTIONS, ["train", "test"])


def hash_split_nested(wh: Warehouse) -> DataFrame:
    """0.1 split off, the rest split 0.65 / 0.35."""
    return fx.hash_split_nested(
        wh.orders.select("o_orderkey"), "o_orderkey", *NESTED_SPLIT, ["held_out", "train", "test"]
    )


def _rule_predictions(wh: Warehouse) -> DataFrame:
    f = analog.client_features(wh)
    return f.select(
        tolerant_double("hired").alias("label"),
        F.when(F.col("S_years") >= RULE_MIN_YEARS, 1.0).otherwise(0.0).alias("prediction"),
    )


def confusion_counts(wh: Warehouse) -> DataFrame:
    """Label x prediction counts of the fixed rule."""
    return metrics.confusion_counts(_rule_predictions(wh))


def classification_metrics(wh: Warehouse) -> DataFrame:
    """Accuracy and weighted precision / recall / F1 of the fixed rule."""
    return metrics.classification_metrics(_rule_predictions(wh))
