"""Classification metrics as aggregations over the confusion counts.

The confusion table has (number of classes)^2 rows at most, so everything after
the first aggregation is tiny; the only pass over the predictions is the
partial + final count per (label, prediction).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import r6
from quarry.operators.ranking import with_running_sum


def confusion_counts(pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """(label, prediction, n)."""
    return pred.groupBy(
        F.col(label_col).cast("double").alias("label"), F.col(prediction_col).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(
    pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction"
) -> DataFrame:
    """One row: n, accuracy, weighted precision / recall / F1, and ``f1_error = 1 - F1``.

    Weighted means each true class weighs by its share of rows, as in
    ``MulticlassClassificationEvaluator`` (whose default metric is weighted F1).
    """
    conf = confusion_counts(pred, label_col, prediction_col)
    # Each confusion cell counts once for its true class and once for its
    # predicted class: one pass over the (tiny) confusion table, no self-join.
    zero = F.lit(0).cast("bigint")
    as_true = F.struct(
        F.col("label").alias("c"), F.col("n").alias("n_true"), zero.alias("n_pred"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero).alias("tp"),
    )
    as_pred = F.struct(F.col("prediction").alias("c"), zero.alias("n_true"), F.col("n").alias("n_pred"), zero.alias("tp"))
    cells = conf.select(F.explode(F.array(as_true, as_pred)).alias("s")).select("s.*")
    per_class = (
        cells.groupBy("c")
        .agg(F.sum("n_true").alias("n_c"), F.sum("n_pred").alias("pn"), F.sum("tp").alias("tp"))
        .filter(F.col("n_c") > 0)  # classes that are only predicted carry no weight
    )
    precision = F.when(F.col("pn") > 0, F.col("tp") / F.col("pn")).otherwise(F.lit(0.0))
    f1 = F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (F.col("n_c") + F.col("pn"))).otherwise(F.lit(0.0))
    totals = per_class.agg(
        F.sum("n_c").alias("n"),
        (F.sum("tp") / F.sum("n_c")).alias("accuracy"),
        (F.sum(F.col("n_c") * precision) / F.sum("n_c")).alias("weighted_precision"),
        (F.sum("tp") / F.sum("n_c")).alias("weighted_recall"),
        (F.sum(F.col("n_c") * f1) / F.sum("n_c")).alias("weighted_f1"),
    )
    return totals.select(
        F.col("n").cast("bigint").alias("n"),
        r6(F.col("accuracy")).alias("accuracy"),
        r6(F.col("weighted_precision")).alias("weighted_precision"),
        r6(F.col("weighted_recall")).alias("weighted_recall"),
        r6(F.col("weighted_f1")).alias("weighted_f1"),
        r6(1.0 - F.col("weighted_f1")).alias("f1_error"),
    )


def area_under_curve(scored: DataFrame, score_col: str, label_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``group_cols..., n, positives, auc``: the exact area under the ROC curve, ties counted as half.

    Labels above 0.5 are positive; rows with a null score or label take no part. The area is the rank sum of the positives:
    rows are first counted per (group, score), so a frequent score is one row, and the negatives below a score come from
    a running sum over the range-sorted scores of all groups. A group of one class has no area (null).
    """
    group = list(group_cols)
    hit = (F.col(label_col) > 0.5).cast("bigint")
    rows = scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
    per_score = rows.groupBy(*group, F.col(score_col).alias("_score")).agg(
        F.sum(hit).alias("_up"), F.sum(F.lit(1).cast("bigint") - hit).alias("_down")
    )
    below = with_running_sum(per_score, [*group, "_score"], "_down", "_before")
    # The running sum passes over all groups: within one, the sum at its first score is taken off.
    totals = below.groupBy(*group).agg(
        F.sum("_up").alias("p"), F.sum("_down").alias("n"), F.min("_before").alias("start"),
        F.sum(F.col("_up") * (F.col("_before") + F.col("_down") / F.lit(2.0))).alias("area"),
    )
    area = (F.col("area") - F.col("p") * F.col("start")) / (F.col("p") * F.col("n"))
    return totals.select(
        *group, (F.col("p") + F.col("n")).alias("n"), F.col("p").alias("positives"),
        F.when((F.col("p") > 0) & (F.col("n") > 0), r6(area)).alias("auc"),
    )
