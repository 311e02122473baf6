"""Results of a cross-validated grid as a table."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import r6
from quarry.operators.metrics import area_under_curve
from quarry.operators.models import hash_text, materialize


def grid_table(train: DataFrame, fitted, fold_col: str, label_col: str = "label") -> DataFrame:
    """``fold, num_features, reg_param, n, positives, auc, mean_auc, best``: one row per fold and parameter map of a ``grid_search`` with kept models.

    Every model scores the rows of its own fold, whose texts are hashed once a width; all areas come from one pass over the scores, exact also for ties.
    ``best`` marks the parameters of the largest mean area over the folds (of equals, the fewest features, then the smallest penalty).
    """
    widths = sorted({v for params in fitted.getEstimatorParamMaps() for p, v in params.items() if p.name == "numFeatures"})
    train = materialize(hash_text(train.select("text", label_col, fold_col), widths), "grid-rows")
    scored = []
    for fold, models in enumerate(fitted.subModels):
        held_out = train.where(F.col(fold_col) == fold)
        for params, model in zip(fitted.getEstimatorParamMaps(), models):
            named = {p.name: v for p, v in params.items()}
            out = model.transform(held_out).select(
                F.lit(fold).alias("fold"), F.lit(named["numFeatures"]).alias("num_features"), F.lit(named["regParam"]).alias("reg_param"),
                vector_to_array("probability")[1].alias("score"), F.col(label_col).alias("label"),
            )
            scored.append(out)
    cell = ["num_features", "reg_param"]
    table = area_under_curve(reduce(DataFrame.union, scored), "score", "label", ["fold", *cell])
    means = table.groupBy(*cell).agg(F.avg("auc").alias("mean_auc"))
    top = means.orderBy(F.desc("mean_auc"), *cell).limit(1).select(*cell, F.lit(True).alias("best"))
    return table.join(means, cell).join(top, cell, "left").select(
        "fold", *cell, "n", "positives", "auc", r6("mean_auc").alias("mean_auc"), F.coalesce("best", F.lit(False)).alias("best")
    )
