"""A forest of Spark decision trees on bootstrap weights that SQL can state.

Spark's own forest draws its bags by partition. Here a tree's bag is a weight column, Poisson draws
keyed by (tree, row), and its features are drawn by (tree); the trees themselves are
``DecisionTreeClassifier`` fits that run side by side. The prediction is one table of votes.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.models import materialize
from quarry.operators.sampling import bag_weight, draw, fresh

Tree = tuple[list[str], DecisionTreeClassificationModel]


def drawn_features(spark: SparkSession, cols: Sequence[str], n_trees: int, per_tree: int, seed: int) -> list[list[str]]:
    """Per tree the ``per_tree`` columns of smallest draw, in the order of ``cols``."""
    draws = spark.range(n_trees).select("id", F.array(*[draw(seed, F.lit(c), F.col("id")) for c in cols]).alias("d"))
    chosen = []
    for row in draws.orderBy("id").collect():
        kept = sorted(range(len(cols)), key=lambda i: (row.d[i], i))[:per_tree]
        chosen.append([cols[i] for i in sorted(kept)])
    return chosen


def bagged_trees(
    train: DataFrame, label: str, cols: Sequence[str], key: str, n_trees: int, per_tree: int, seed: int, max_depth: int = 5, parallel: int = 8
) -> list[Tree]:
    """``n_trees`` trees. All bags are drawn in one pass; rows that are equal in label and columns are one row with their weights
    added, which a tree of weighted rows cannot tell apart."""
    weights = [fresh(f"w{t}", [label, *cols]) for t in range(n_trees)]
    all_bags = F.array(*[bag_weight(seed, t, key).cast("tinyint") for t in range(n_trees)])
    drawn = train.select(label, *cols, all_bags.alias("bags"))
    bags = drawn.groupBy(label, *cols).agg(*[F.sum(F.col("bags")[t]).cast("double").alias(w) for t, w in enumerate(weights)])
    bags = materialize(bags, "bags")

    def one(t: int, own: list[str]) -> Tree:
        rows = bags.select(label, *own, weights[t]).where(F.col(weights[t]) > 0)
        rows = VectorAssembler(inputCols=own, outputCol="_x").transform(rows)
        fit = DecisionTreeClassifier(labelCol=label, featuresCol="_x", weightCol=weights[t], maxDepth=max_depth, seed=seed)
        return own, fit.fit(rows)

    chosen = drawn_features(train.sparkSession, cols, n_trees, per_tree, seed)
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(one, range(n_trees), chosen))


def votes(trees: Sequence[Tree], rows: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``key, votes`` (the class each tree votes for, as an array)."""
    out = rows.select(key, *cols)
    for t, (own, model) in enumerate(trees):
        out = VectorAssembler(inputCols=own, outputCol="_x").transform(out)
        out = model.copy().setFeaturesCol("_x").setRawPredictionCol("").setProbabilityCol("").setPredictionCol(f"_v{t}").transform(out).drop("_x")
    return out.select(key, F.array(*[f"_v{t}" for t in range(len(trees))]).alias("votes"))


def majority(table: DataFrame, key: str) -> DataFrame:
    """``key, votes_1, prediction`` of two classes; a tie is class 0."""
    ones = F.aggregate("votes", F.lit(0).cast("bigint"), lambda n, v: n + v.cast("bigint"))
    return table.select(key, ones.alias("votes_1"), F.when(ones * 2 > F.size("votes"), 1.0).otherwise(0.0).alias("prediction"))
