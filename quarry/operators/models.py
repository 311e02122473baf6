"""Model operators on ``pyspark.ml`` estimators, made reproducible.

``randomSplit`` and the tree / cluster samplers depend on how rows fall into
partitions, so seeds alone do not make a fit repeatable. ``stable_layout``
fixes the layout (hash-partition by a key into a fixed number of partitions,
sort inside each) and ``materialize`` writes the result as a parquet table in
the shared checkpoint folder: the iterative fits then re-read a stable,
lineage-free input, and a lost executor costs a re-read, not a recompute of
the joins that built it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.param.shared import HasInputCol, HasNumFeatures, HasOutputCol
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import unit_hash
from quarry.session import scratch_path

DEFAULT_SEED = 7
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stable_layout(
    df: DataFrame, keys: Sequence[str], n_partitions: int, order: Sequence[str] | None = None
) -> DataFrame:
    """Fixed partitioning and in-partition order for reproducible fits.

    Rows are hash-partitioned by ``keys`` and sorted by ``order`` (default: the
    keys). When the keys are not unique, ``order`` must extend them to a total
    order (e.g. all columns), or tied rows keep their shuffle-fetch order, which
    varies between runs. ``n_partitions`` is sized to the data, never 1.
    """
    if n_partitions < 1:
        raise ValueError("n_partitions must be positive")
    return df.repartition(n_partitions, *keys).sortWithinPartitions(*(order or keys))


def materialize(df: DataFrame, label: str = "model-input") -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts lineage like a reliable checkpoint (never a local one) but computes the
    plan once (an eager ``checkpoint`` runs it for the count and again for the
    write), stores it columnar and compressed, and lets later fits prune columns.
    The folder is ``spark.checkpoint.dir`` taken from the session.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # once the table stands, the shuffle files behind it are of no use
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.parquet(path)


def fixed_layout(table: DataFrame, key: str, vector_col: str | None = None, rows_per_partition: int = 100_000, made=None) -> DataFrame:
    """Rows of a written table in a layout that its rows alone decide.

    Files are read in splits that depend on cores and settings, and samplers and float sums
    depend on the splits. Here the number of partitions follows from the row count, rows are
    dealt by ``key``, and sorted by every column (a vector by its storage struct), so rows
    that tie are equal rows. ``made`` maps the dealt rows before they are sorted, so wide columns are not dealt.
    """
    n = max(1, -(-table.count() // rows_per_partition))
    dealt = table.repartition(n, key)
    if made is not None:
        dealt = made(dealt)
    order = [F.unwrap_udt(F.col(c)) if c == vector_col else F.col(c) for c in dealt.columns]
    return dealt.sortWithinPartitions(key, *order)


def decision_tree(train: DataFrame, label_col: str, features_col: str, seed: int = DEFAULT_SEED,
                  max_depth: int = 5, max_bins: int = 32):
    """Gini decision tree, depth 5, 32 bins."""
    return DecisionTreeClassifier(
        labelCol=label_col, featuresCol=features_col, maxDepth=max_depth, maxBins=max_bins, seed=seed
    ).fit(train)


def random_forest(train: DataFrame, label_col: str, features_col: str, num_trees: int,
                  seed: int = DEFAULT_SEED, max_depth: int = 5):
    return RandomForestClassifier(
        labelCol=label_col, featuresCol=features_col, numTrees=num_trees, maxDepth=max_depth, seed=seed
    ).fit(train)


def kmeans(df: DataFrame, k: int, features_col: str, seed: int = 1, max_iter: int = 20):
    """k-means (k-means|| initialisation); the model holds k centres only."""
    return KMeans(k=k, seed=seed, featuresCol=features_col, maxIter=max_iter).fit(df)


def text_classifier(num_features: int = 1 << 18, max_iter: int = 10, reg_param: float = 0.0,
                    text_col: str = "text", label_col: str = "label"):
    """Tokenizer -> HashingTF -> LogisticRegression; returns (pipeline, tf, lr)."""
    tok = Tokenizer(inputCol=text_col, outputCol="words")
    tf = HashingTF(inputCol="words", outputCol="features", numFeatures=num_features)
    lr = LogisticRegression(maxIter=max_iter, regParam=reg_param, labelCol=label_col)
    return Pipeline(stages=[tok, tf, lr]), tf, lr


def _hashed_name(width: int) -> str:
    return f"hashed_{width}"


def hash_text(df: DataFrame, widths: Sequence[int], text_col: str = "text") -> DataFrame:
    """``df`` with the hashed word counts of every width in place of the text; a text is split once for all widths."""
    hashed = Tokenizer(inputCol=text_col, outputCol="split_words").transform(df)
    for width in widths:
        hashed = HashingTF(inputCol="split_words", outputCol=_hashed_name(width), numFeatures=width).transform(hashed)
    return hashed.drop("split_words", text_col)


class HashedText(Transformer, HasInputCol, HasOutputCol, HasNumFeatures):
    """Tokenizer -> HashingTF as one stage that takes the column of ``hash_text`` if the rows have it."""

    def __init__(self, num_features: int, input_col: str = "text", output_col: str = "features"):
        super().__init__()
        self._set(numFeatures=num_features, inputCol=input_col, outputCol=output_col)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        width, text = self.getNumFeatures(), self.getInputCol()
        if _hashed_name(width) not in dataset.columns:
            dataset = hash_text(dataset.withColumn("split_text", F.col(text)), [width], "split_text")
        return dataset.withColumnRenamed(_hashed_name(width), self.getOutputCol())


def fold_column(key: str, n_folds: int):
    """Deterministic fold number from the key (``CrossValidator(foldCol=...)``)."""
    return F.pmod(unit_hash(key), F.lit(n_folds)).cast("int")


def grid_search(train: DataFrame, num_features: Sequence[int], reg_params: Sequence[float],
                fold_col: str, max_iter: int = 10, parallelism: int | None = None, label_col: str = "label",
                keep_models: bool = False):
    """Cross-validated grid over hash width x regularisation; folds come from ``fold_col``.

    The parameter maps of one fold are fitted concurrently (``parallelism``, by
    default one per map up to the cluster's parallelism); each fit is itself a
    distributed job, so this only overlaps their scheduling gaps. With ``keep_models`` the
    fitted model carries the model of every fold and parameter map. Texts are split and hashed
    once for all fits, in the layout of ``train``.
    """
    _, _, lr = text_classifier(max_iter=max_iter, label_col=label_col)
    tf = HashedText(num_features[0])
    pipeline = Pipeline(stages=[tf, lr])
    grid = ParamGridBuilder().addGrid(tf.numFeatures, list(num_features)).addGrid(lr.regParam, list(reg_params)).build()
    if parallelism is None:
        parallelism = max(1, min(len(grid), train.sparkSession.sparkContext.defaultParallelism))
    cv = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol=label_col),
        foldCol=fold_col,
        parallelism=parallelism,
        collectSubModels=keep_models,
    )
    needed = hash_text(train.select("text", label_col, fold_col), num_features).persist(StorageLevel.DISK_ONLY)
    try:
        return cv.fit(needed)
    finally:
        needed.unpersist()
