"""Keys that hold model operators against exact SQL.

Hashed vectors are given in long form (key, slot, value); a tree of one split and a full
rotation have results that SQL can state.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import r6
from quarry.operators import decomposition, models
from quarry.operators import features as fx
from quarry.plans import feature_keys, model_jobs, text_reports
from quarry.sources.tables import Warehouse


SLOT_ROWS = 50_000


def _slots(parts: DataFrame, key: str) -> DataFrame:
    """``key, slot, value``; the values of rows that share a key are added.

    The rows are dealt by key before they multiply, to as many tasks as their number asks for, so what a task
    holds does not grow with the input.
    """
    table = models.materialize(parts.select(key, "indices", "values"), "slots")
    dealt = table.repartition(max(1, -(-table.count() // SLOT_ROWS)), key)
    entry = F.explode(F.arrays_zip("indices", "values")).alias("e")
    slots = dealt.select(key, entry).select(key, F.col("e.indices").cast("bigint").alias("slot"), F.col("e.values").alias("v"))
    return slots.groupBy(key, "slot").agg(r6(F.sum("v")).alias("value"))


def hashing_tf_slots(wh: Warehouse) -> DataFrame:
    """M3: hashed term frequencies as (doc_id, slot, value)."""
    return _slots(text_reports.hashing_tf(wh), "doc_id")


def feature_hash_slots(wh: Warehouse) -> DataFrame:
    """M8: hashed model columns as (row_key, slot, value)."""
    return _slots(model_jobs.feature_hash(wh), "row_key")


def decision_stump(wh: Warehouse) -> DataFrame:
    """A tree of depth 1 on the years column, whose 29 whole values are all tried as splits."""
    rows = fx.assemble(model_jobs.model_input(wh).select("row_key", "label", "S_years"), ["S_years"], "features")
    model = models.decision_tree(rows, "label", "features", max_depth=1)
    return model.transform(rows).select("row_key", "label", "prediction")


def pca_rotation(wh: Warehouse) -> DataFrame:
    """All three components of the shape columns; a rotation keeps each row's squared length."""
    shape = feature_keys.shape_vectors(wh)
    width = len(feature_keys.SHAPE_COLS)
    turned = fx.pca(shape, "shape", "components", k=width, width=width)
    squares = F.transform(vector_to_array("components"), lambda x: x * x)
    total = F.aggregate(squares, F.lit(0.0), lambda a, x: a + x)
    return turned.select("page_id", F.round(total).cast("bigint").alias("squared_length"))


def pca_components(wh: Warehouse) -> DataFrame:
    """Weights and variances of all three components of the shape columns, by block power iteration."""
    points = fx.sparse_vector_parts(feature_keys.shape_vectors(wh), "shape", ["page_id"])
    found = decomposition.principal_components(models.materialize(points, "shape"), len(feature_keys.SHAPE_COLS))
    rows = [
        (j + 1, feature_keys.SHAPE_COLS[slot], float(found.weights[i, j]), float(found.variances[j]))
        for i, slot in enumerate(found.slots.tolist())
        for j in range(len(found.variances))
    ]
    table = wh.spark.createDataFrame(rows, "component int, input string, weight double, variance double")
    return table.select("component", "input", r6("weight").alias("weight"), r6("variance").alias("variance"))


def pca_hashed(wh: Warehouse) -> DataFrame:
    """The first three components of the 2^18-wide hashed model columns per row; no covariance is built."""
    points = models.materialize(model_jobs.feature_hash(wh), "hashed")
    found = decomposition.principal_components(points, 3)
    return decomposition.project(points, found, ["row_key"])
