"""Keys of seeded draws, forests of stumps, Newton steps and ranking areas, each with exact SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import r6
from quarry.operators import forest, logistic, metrics, models
from quarry.operators.partitioning import spread, spread_setting
from quarry.operators.sampling import bag_weight
from quarry.operators.sampling import random_split as split_at_random
from quarry.plans import model_jobs
from quarry.sources.tables import Warehouse

# Seeds, the forest's inputs and sizes, the columns and steps of the narrow regression.
SPLIT_SEED, FOREST_SEED = 11, 17
FOREST_INPUTS = ["S_years", "Resume_Tips", "Resume_OnFile"]
FOREST_INPUTS_PER_TREE = 2
NEWTON_INPUTS = ["kchars", "space_share"]
NEWTON_STEPS, NEWTON_PENALTY = 5, 0.01


def random_split(wh: Warehouse) -> DataFrame:
    """0.7 / 0.3 of rows that have many equals, each drawn on its own."""
    rows = wh.orders.select("o_orderstatus", "o_orderpriority")
    return split_at_random(rows, model_jobs.TRAIN_TEST, ["train", "test"], SPLIT_SEED)


def _forest_rows(wh: Warehouse) -> DataFrame:
    rows = model_jobs.model_rows(wh).select("row_key", "label", *FOREST_INPUTS)
    return models.materialize(spread(rows, ["row_key"], spread_setting(wh.spark)), "forest-rows")


def forest_bags(wh: Warehouse) -> DataFrame:
    """Rows and total weight of the bootstrap sample of each of 28 trees."""
    rows = spread(model_jobs.model_rows(wh).select("row_key"), ["row_key"], spread_setting(wh.spark))
    trees = F.explode(F.sequence(F.lit(0), F.lit(model_jobs.TREES_INDEXED - 1))).alias("tree")
    drawn = rows.select("row_key", trees).withColumn("w", bag_weight(FOREST_SEED, F.col("tree"), "row_key"))
    # Rows that are not drawn are left out of the count, not filtered: a filter would draw every weight once more.
    counts = drawn.groupBy("tree").agg(F.count_if(F.col("w") > 0).alias("n_rows"), F.sum("w").cast("bigint").alias("weight"))
    return counts.where("n_rows > 0")


def forest_votes(wh: Warehouse) -> DataFrame:
    """The vote of 28 stumps, each on its own bootstrap sample and two drawn columns of three."""
    rows = _forest_rows(wh)
    trees = forest.bagged_trees(
        rows, "label", FOREST_INPUTS, "row_key", model_jobs.TREES_INDEXED, FOREST_INPUTS_PER_TREE, FOREST_SEED, max_depth=1
    )
    return forest.majority(forest.votes(trees, rows, "row_key", FOREST_INPUTS), "row_key")


def logistic_newton(wh: Warehouse) -> DataFrame:
    """Intercept and weights of the label on two shape columns of the labelled documents."""
    text = F.col("text")
    spaces = F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))
    rows = wh.documents.join(wh.labels, "doc_id").select(
        F.col("quality").cast("double").alias("label"),
        (F.col("n_chars") / 1000.0).alias("kchars"),
        (spaces / F.col("n_chars")).alias("space_share"),
    )
    weights = logistic.newton(models.materialize(rows, "newton"), "label", NEWTON_INPUTS, NEWTON_STEPS, NEWTON_PENALTY)
    named = list(zip(["intercept", *NEWTON_INPUTS], weights.tolist()))
    return wh.spark.createDataFrame(named, "term string, weight double").select("term", r6("weight").alias("weight"))


def area_under_curve(wh: Warehouse) -> DataFrame:
    """Per language the area that the text's length in hundreds of characters has for the label; many ties."""
    rows = wh.documents.select("doc_id", "lang", F.floor(F.col("n_chars") / 100).alias("score")).join(
        wh.labels.select("doc_id", F.col("quality").alias("label")), "doc_id"
    )
    return metrics.area_under_curve(rows, "score", "label", ["lang"])
