"""Feature operators on ``pyspark.ml`` transformers, plus the reproducible split.

Estimator fits (index labels, scaler moments, PCA covariance) are distributed
aggregations whose driver-side result is bounded by the number of categories or
features, never by the number of rows. ``pca`` checks its width first, ``word2vec`` the
number of words of ``min_count`` occurrences or more, which its training holds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import (
    PCA,
    FeatureHasher,
    Normalizer,
    OneHotEncoder,
    StandardScaler,
    VarianceThresholdSelector,
    VectorAssembler,
    Word2Vec,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import hash_fraction_threshold, r6, unit_hash
from quarry.functions.expressions import HASH_SPACE
from quarry.operators.models import materialize
from quarry.operators.ranking import with_position
from quarry.operators.sampling import fresh

MAX_PCA_WIDTH = 65_535
MAX_WORDS = 5_000_000
ONE_TASK_ROWS = 10_000


class IndexTables:
    """Category -> index (most frequent = 0, ties alphabetical), one written table per column.

    ``fit`` counts values, sorts the counts over all tasks and writes ``value, index``; ``transform`` joins, so
    no list of categories is ever held by the driver or a worker and their number is not limited. ``save`` and ``load`` keep
    a fitted set of tables under a path that Spark can write.
    """

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        self.tables = tables

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> IndexTables:
        tables = {}
        for c in cols:
            counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            counts = materialize(counts, "index-counts")
            order = [F.desc("n"), F.asc("value")]
            if counts.limit(ONE_TASK_ROWS + 1).count() <= ONE_TASK_ROWS:  # the same positions without a range sort
                tables[c] = counts.select("value", (F.row_number().over(Window.orderBy(*order)) - 1).cast("double").alias("index"))
            else:
                index = with_position(counts, order, "index")
                tables[c] = materialize(index.select("value", F.col("index").cast("double").alias("index")), "index")
        return cls(tables)

    def transform(self, df: DataFrame, suffix: str = "Index") -> DataFrame:
        """``df`` with ``<column><suffix>`` per column; a NULL category or one that ``fit`` did not see fails."""
        for c, table in self.tables.items():
            value, index = (fresh(x, df.columns) for x in ("value", "index"))
            message = F.coalesce(F.concat(F.lit(f"no index in {c} for "), F.col(c).cast("string")), F.lit(f"NULL category in {c}"))
            bad = F.raise_error(message).cast("double")
            joined = df.join(table.select(F.col("value").alias(value), F.col("index").alias(index)), F.col(c) == F.col(value), "left")
            df = joined.select(*df.columns, F.coalesce(F.col(index), bad).alias(c + suffix))
        return df

    def save(self, path: str) -> None:
        for c, table in self.tables.items():
            table.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{c}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, cols: Sequence[str]) -> IndexTables:
        return cls({c: spark.read.parquet(f"{path.rstrip('/')}/{c}") for c in cols})


def string_index(
    df: DataFrame,
    input_cols: Sequence[str],
    suffix: str = "Index",
) -> DataFrame:
    """Category -> index (most frequent = 0, ties alphabetical); a NULL category fails."""
    return IndexTables.fit(df, input_cols).transform(df, suffix)


def one_hot(df: DataFrame, input_cols: Sequence[str], suffix: str = "Vec", drop_last: bool = True) -> DataFrame:
    """Index -> one-hot sparse vector; with ``drop_last`` the last index maps to all zeros."""
    enc = OneHotEncoder(
        inputCols=list(input_cols), outputCols=[c + suffix for c in input_cols], dropLast=drop_last
    )
    return enc.fit(df).transform(df)


def assemble(df: DataFrame, input_cols: Sequence[str], output_col: str = "features") -> DataFrame:
    """Columns -> one vector (NULL or text inputs fail, as in ``VectorAssembler``)."""
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col, handleInvalid="error").transform(df)


def standard_scale(df: DataFrame, input_col: str, output_col: str, with_mean: bool = False) -> DataFrame:
    """Divide each feature by its sample standard deviation (constant feature -> 0)."""
    scaler = StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=True)
    return scaler.fit(df).transform(df)


def normalize(df: DataFrame, input_col: str, output_col: str, p: float = 1.0) -> DataFrame:
    """Scale each vector to unit p-norm (a zero vector stays zero)."""
    return Normalizer(inputCol=input_col, outputCol=output_col, p=p).transform(df)


def feature_hash(
    df: DataFrame, input_cols: Sequence[str], output_col: str = "features", num_features: int = 1 << 18
) -> DataFrame:
    """Mixed columns -> one sparse vector: numbers keep their value at hash(col),
    text and booleans give 1.0 at hash(col=value), NULLs are skipped."""
    return FeatureHasher(inputCols=list(input_cols), outputCol=output_col, numFeatures=num_features).transform(df)


class SlotBundles:
    """Hashed text columns as one ordered code each, for tree learners that bin every slot of a row.

    A text column sets exactly one of its slots in a hashed vector, so its slots exclude each other and fit in one
    feature: the slot's position by the share of positive labels among the training rows that have it (equal shares by slot),
    the order in which a split on two classes is sought anyway. A row then has as many features as columns, however many
    names there are. Codes are written tables (``slot, code``), joined and never collected; a slot that the training rows
    do not have, and NULL, are code -1. Slots that two columns share by a hash collision stay apart.
    """

    def __init__(self, tables: dict[str, DataFrame], num_features: int) -> None:
        self.tables, self.num_features = tables, num_features

    @staticmethod
    def with_slots(df: DataFrame, cols: Sequence[str], num_features: int = 1 << 18, suffix: str = "Slot") -> DataFrame:
        """``df`` with the hashed slot of every text column (NULL for NULL)."""
        for c in cols:
            vector = fresh("vector", df.columns)
            hashed = feature_hash(df, [c], vector, num_features)
            df = hashed.withColumn(c + suffix, F.get(F.unwrap_udt(F.col(vector))["indices"], F.lit(0))).drop(vector)
        return df

    @classmethod
    def fit(cls, train: DataFrame, cols: Sequence[str], label_col: str, num_features: int = 1 << 18) -> SlotBundles:
        tables = {}
        for c in cols:  # values are counted before they are hashed, each once
            known = train.where(F.col(c).isNotNull()).groupBy(c).agg(F.sum(label_col).alias("up"), F.count(label_col).alias("n"))
            share = cls.with_slots(known, [c], num_features).groupBy(F.col(c + "Slot").alias("slot"))
            share = share.agg(F.try_divide(F.sum("up"), F.sum("n")).alias("share"))
            code = with_position(share, ["share", "slot"], "code").select("slot", F.col("code").cast("double").alias("code"))
            tables[c] = materialize(code, "bundle")
        return cls(tables, num_features)

    def transform(self, df: DataFrame, suffix: str = "Code") -> DataFrame:
        """``df`` with ``<column><suffix>`` per text column."""
        columns, df = df.columns, self.with_slots(df, list(self.tables), self.num_features, "Slot")
        for c, table in self.tables.items():
            slot, code = (fresh(x, df.columns) for x in ("slot", "code"))
            joined = df.join(table.toDF(slot, code), F.col(c + "Slot") == F.col(slot), "left")
            df = joined.withColumn(c + suffix, F.coalesce(F.col(code), F.lit(-1.0))).drop(slot, code)
        return df.select(*columns, *[c + suffix for c in self.tables])


def active_features(df: DataFrame, input_col: str, output_col: str) -> DataFrame:
    """Keep only the vector slots that vary (variance > 0), in index order.

    Compacts hashed vectors to their used buckets; the fit is one distributed
    summary pass whose result has one number per slot.
    """
    sel = VarianceThresholdSelector(featuresCol=input_col, outputCol=output_col, varianceThreshold=0.0)
    return sel.fit(df).transform(df)


def pca(df: DataFrame, input_col: str, output_col: str, k: int, width: int) -> DataFrame:
    """Project on the top-k principal components. The covariance is width x width on
    the driver, so the input width is checked first (hashed 2^18 vectors are refused)."""
    if width > MAX_PCA_WIDTH:
        raise ValueError(f"PCA input of width {width} exceeds {MAX_PCA_WIDTH}")
    if k > width:
        raise ValueError("k exceeds the input width")
    return PCA(k=k, inputCol=input_col, outputCol=output_col).fit(df).transform(df)


def word2vec(
    df: DataFrame,
    input_col: str,
    output_col: str,
    vector_size: int = 100,
    min_count: int = 5,
    seed: int = 42,
    num_partitions: int = 8,
    max_iter: int = 1,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """Word vectors; a row's vector (an array) is the mean of its words' vectors.

    ``num_partitions`` > 1 so that training is not one task over all sentences. Training holds the words of ``min_count``
    occurrences or more on the driver; more than ``max_words`` of them are refused. The vectors are then a written table.
    """
    words = df.select(F.explode(input_col).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    if words.limit(max_words + 1).count() > max_words:
        raise ValueError(f"more than {max_words} words occur {min_count} times or more")
    model = Word2Vec(
        inputCol=input_col,
        outputCol=output_col,
        vectorSize=vector_size,
        minCount=min_count,
        seed=seed,
        numPartitions=num_partitions,
        maxIter=max_iter,
    ).fit(df.select(input_col))
    return mean_vectors(df, input_col, output_col, materialize(model.getVectors(), "word-vectors"), vector_size)


def mean_vectors(df: DataFrame, input_col: str, output_col: str, vectors: DataFrame, size: int) -> DataFrame:
    """``df`` with ``output_col``: the sum of the vectors (``word, vector``) of a row's words over the number of its words.

    As in ``Word2VecModel.transform`` words without a vector count as zeros and a row without words gets zeros; a null list gives null.
    The vectors are joined to the words of the different lists, so no worker holds all vectors and a frequent list is averaged once.
    """
    words, word = fresh("words", df.columns), F.explode("words").alias("word")
    lists = df.select(F.col(input_col).alias("words")).where(F.size("words") > 0).distinct()
    found = lists.select("words", word).join(vectors, "word").groupBy("words").agg(Summarizer.sum(F.col("vector")).alias("total"))
    found = found.select(F.col("words").alias(words), vector_to_array("total").alias("_total"))
    zeros = F.array_repeat(F.lit(0.0), size)
    mean = F.coalesce(F.transform("_total", lambda x: x / F.size(input_col)), zeros)
    return df.join(found, F.col(input_col) == F.col(words), "left").select(
        *[F.col(f"`{c}`") for c in df.columns], F.when(F.col(input_col).isNotNull(), mean).alias(output_col)
    )


def flatten_vector(df: DataFrame, vector_col: str, names: Sequence[str], keep: Sequence[str], round6: bool = True) -> DataFrame:
    """Vector -> named double columns (``vector_to_array`` runs in the JVM)."""
    arr = vector_to_array(F.col(vector_col))
    outs = [(r6(arr[i]) if round6 else arr[i]).alias(n) for i, n in enumerate(names)]
    return df.select(*keep, *outs)


def vector_long(df: DataFrame, vector_col: str, keep: Sequence[str]) -> DataFrame:
    """Vector -> one row per slot ``(keep..., slot, value)``; for narrow vectors only."""
    return df.select(*keep, F.posexplode(vector_to_array(F.col(vector_col))).alias("slot", "value")).select(
        *keep, F.col("slot").cast("bigint").alias("slot"), "value"
    )


def vector_entries(df: DataFrame, vector_col: str, keep: Sequence[str]) -> DataFrame:
    """Vector -> one row per non-zero slot ``(keep..., slot, value)``, never densified; a zero vector is one row with a
    NULL slot and value 0."""
    parts = sparse_vector_parts(df, vector_col, keep)
    entries = F.filter(F.arrays_zip("indices", "values"), lambda e: e["values"] != 0)
    entry = parts.select(*keep, F.explode_outer(entries).alias("e"))
    return entry.select(*keep, F.col("e.indices").cast("bigint").alias("slot"), F.coalesce("e.values", F.lit(0.0)).alias("value"))


def sparse_vector_parts(df: DataFrame, vector_col: str, keep: Sequence[str]) -> DataFrame:
    """Vector -> ``(keep..., size, indices, values)`` with plain SQL types, without
    densifying (a 2^18-wide hashed vector stays as its non-zero entries): the fields of
    its storage struct; dense vectors get their indices from the positions."""
    parts = F.unwrap_udt(F.col(vector_col))
    values = parts["values"]
    indices = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(values) - 1))
    return df.select(
        *keep,
        F.coalesce(parts["size"], F.size(values)).cast("int").alias("size"),
        indices.alias("indices"),
        values.alias("values"),
    )


def hash_split(df: DataFrame, key: str, fractions: Sequence[float], names: Sequence[str], out: str = "split") -> DataFrame:
    """Label each row with a split name from the multiplicative hash of ``key``.

    Unlike ``randomSplit``, the assignment depends on the key alone, so it is the
    same for any partitioning, any run, and in SQL.
    """
    if len(fractions) != len(names) or abs(sum(fractions) - 1.0) > 1e-9:
        raise ValueError("fractions must match names and sum to 1")
    h = unit_hash(key)
    bounds, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        bounds.append(hash_fraction_threshold(acc))
    expr = None
    for b, name in zip(bounds, names[:-1]):
        expr = F.when(h < b, F.lit(name)) if expr is None else expr.when(h < b, F.lit(name))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return df.withColumn(out, expr)


def nested_split_bounds(first: float, second: float) -> tuple[int, int]:
    """Bounds for a split of ``first`` / rest, the rest split again ``second`` / rest."""
    t1 = hash_fraction_threshold(first)
    t2 = t1 + math.ceil(second * (HASH_SPACE - t1))
    return t1, t2


def hash_split_nested(df: DataFrame, key: str, first: float, second: float, names: Sequence[str], out: str = "split") -> DataFrame:
    """Split ``first`` off, then split the rest ``second`` / ``1 - second``."""
    t1, t2 = nested_split_bounds(first, second)
    h = unit_hash(key)
    return df.withColumn(
        out, F.when(h < t1, F.lit(names[0])).when(h < t2, F.lit(names[1])).otherwise(F.lit(names[2]))
    )
