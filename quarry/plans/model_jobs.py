"""Model jobs (R10-R13) and the model keys they are built from (M8, M12, M13,
M16-M19, M21). All rows-only checked: fitted models have no SQL twin.

Each job materialises its model input once (stable, totally ordered layout,
written as a parquet table in the shared checkpoint folder), and again after
the feature pipeline (train and test together), so the estimator fits and the
scoring read stored rows instead of re-running the star join or the pipeline,
and a lost executor re-reads instead of recomputing. The indexed jobs store the
narrow inputs instead of the wide vectors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    OneHotEncoder,
    StandardScaler,
    VectorAssembler,
    Word2Vec,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import pattern_count, regex_tokens, tolerant_double
from quarry.operators import features as fx
from quarry.operators import clustering, metrics, models, text, tuning
from quarry.operators.partitioning import spread, spread_setting
from quarry.operators.relational import distinct_of, numeric_summary, summary_by_group
from quarry.plans import analog
from quarry.sources.tables import Warehouse

# Fixed values of the hiring jobs: inputs of the hashed vector, the categories that
# are indexed and one-hot coded, the numeric inputs, and the model sizes.
HASHED_INPUTS = [
    "S_years", "R_years", "Resume_Tips", "Resume_OnFile", "Client", "Client_Type", "Service_R",
    "Service_B", "Confirmed_hire", "Com_Method", "responsive", "active", "Created_Linkedin", "Educ", "Occupation",
]
CATEGORIES = ["Service_B", "Com_Method", "active", "Service_R", "Client_Type"]
NUMERIC_INPUTS = ["Resume_Tips", "Resume_OnFile", "Client", "Confirmed_hire", "responsive", "Created_Linkedin"]
YEAR_INPUTS = ["S_years", "R_years"]
TREES_INDEXED = 28
TREES_HASHED = 17
KMEANS_K = 4
KMEANS_STEPS = 20
TRAIN_TEST = (0.7, 0.3)
TRAIN_TEST_HASHED = (0.75, 0.25)
VOCAB_SIZE = 1500
PCA_K = 120
GRID_HASH_SIZES = (10, 100, 1000)
GRID_REG_PARAMS = (0.1, 0.01)
GRID_FOLDS = 3
GRID_ROWS = 20_000  # of a partition: whole texts are sorted and hashed, so many short tasks


W2V_PARTITIONS = 8  # Word2Vec trains one model copy per partition and averages them: a fixed parameter


def model_rows(wh: Warehouse) -> DataFrame:
    """Filtered star join + double label + a row key (lazy)."""
    base = analog.client_features(wh)
    # line numbers are 1..7, so order_id * 16 + line_no stays unique per (order,
    # line) and within BIGINT for any order key below 2^59.
    return base.select(
        (F.col("order_id") * 16 + F.col("line_no")).alias("row_key"),
        tolerant_double("hired").alias("label"),
        *[c for c in base.columns if c != "hired"],
    )


def model_input(wh: Warehouse) -> DataFrame:
    """``model_rows``, materialised once."""
    return models.fixed_layout(models.materialize(model_rows(wh)), "row_key")


def indexed_rows(wh: Warehouse) -> DataFrame:
    """``row_key, label``, the inputs of both variants, category indexes and the education text, written once.

    These rows are some ten times narrower than the vectors made of them, so vectors are never written or shuffled:
    ``indexed_model`` makes them anew in the tasks of every pass.
    """
    kept = ["row_key", "label", *YEAR_INPUTS, *NUMERIC_INPUTS, *CATEGORIES, "Educ"]
    rows = models.materialize(model_rows(wh).select(*kept))
    return models.materialize(fx.IndexTables.fit(rows, CATEGORIES).transform(rows).drop(*CATEGORIES), "indexed")


def _with_words(rows: DataFrame) -> DataFrame:
    return rows.withColumn("EducWords", analog.education_tokens(F.col("Educ")))


def indexed_model(rows: DataFrame, variant: str, n_partitions: int) -> PipelineModel:
    """Fitted stages over ``indexed_rows``: one-hot (of indexed columns) -> (word vectors) ->
    assemble -> scale. The indexes come from ``features.IndexTables``.

    Variant A: one-hot drops the last category, adds the education word vector,
    leaves the year columns out. Variant B: all categories kept, year columns in,
    no word vector.
    """
    indexed = [c + "Index" for c in CATEGORIES]
    one_hot = OneHotEncoder(inputCols=indexed, outputCols=[c + "Vec" for c in indexed], dropLast=(variant == "A"))
    stages = [one_hot.fit(rows)]  # the largest index of each column, in any order of rows
    inputs = list(NUMERIC_INPUTS) + [c + "Vec" for c in indexed]
    if variant == "A":
        words = _with_words(models.fixed_layout(rows.select("row_key", "Educ"), "row_key")).select("EducWords")
        stages.append(Word2Vec(inputCol="EducWords", outputCol="EducVec", vectorSize=100, minCount=5,
                               seed=models.DEFAULT_SEED, numPartitions=n_partitions).fit(words))
        inputs.append("EducVec")
    else:
        inputs = YEAR_INPUTS + inputs
    stages.append(VectorAssembler(inputCols=inputs, outputCol="vecfeatures", handleInvalid="error"))
    assembled = PipelineModel(stages).transform(_with_words(models.fixed_layout(rows, "row_key")))
    stages.append(StandardScaler(inputCol="vecfeatures", outputCol="features", withMean=False, withStd=True).fit(assembled))
    return PipelineModel(stages)


def indexed_features(wh: Warehouse, variant: str = "A") -> tuple[DataFrame, DataFrame]:
    """The indexed-feature model input as train and test part, split 0.7 / 0.3 by the row-key hash."""
    rows = indexed_rows(wh)
    fitted = indexed_model(rows, variant, W2V_PARTITIONS)
    split = fx.hash_split(rows, "row_key", TRAIN_TEST, ["train", "test"])
    part = lambda name: split.where(F.col("split") == name).drop("split")
    features = lambda df: fitted.transform(_with_words(df)).select("row_key", "label", "features")
    return models.fixed_layout(part("train"), "row_key", "features", made=features), features(part("test"))


def _train_test(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The transformed, split rows written once: the iterative fits read the
    train part and every model scores the test part without re-running the
    feature pipeline. The train part is laid out anew after the read."""
    cols = ["row_key", "label", "features"]
    table = models.materialize(split.select(*cols, "split"), "split")
    train = models.fixed_layout(table.filter(F.col("split") == "train").select(*cols), "row_key", "features")
    test = table.filter(F.col("split") == "test").select(*cols)
    return train, test


def _predictions(model, test: DataFrame) -> DataFrame:
    return model.transform(test).select("row_key", "label", "prediction")


def decision_tree(wh: Warehouse, variant: str = "A") -> DataFrame:
    """Tree predictions on the held-out rows.

    Variant A includes Word2Vec vectors, whose multi-partition training is not
    bit-reproducible in Spark (it repartitions sentences internally); every
    other stage is, so variant B gives identical predictions run after run.
    """
    train, test = indexed_features(wh, variant)
    return _predictions(models.decision_tree(train, "label", "features"), test)


def random_forest(wh: Warehouse) -> DataFrame:
    """28-tree forest predictions on the held-out rows."""
    train, test = indexed_features(wh, "A")
    return _predictions(models.random_forest(train, "label", "features", TREES_INDEXED), test)


def _score_models(train: DataFrame, test: DataFrame, n_trees: int, variant: str) -> DataFrame:
    tree = _predictions(models.decision_tree(train, "label", "features"), test)
    forest = _predictions(models.random_forest(train, "label", "features", n_trees), test)
    scored = [
        metrics.classification_metrics(p).select(F.lit(variant).alias("variant"), F.lit(name).alias("model"), "*")
        for name, p in (("decision_tree", tree), ("random_forest", forest))
    ]
    return reduce(DataFrame.unionByName, scored)


def hiring_model_indexed(wh: Warehouse) -> DataFrame:
    """R11 variant A: indexed features -> tree and 28-tree forest -> scores."""
    return _score_models(*indexed_features(wh, "A"), TREES_INDEXED, "indexed_a")


def hiring_model_indexed_b(wh: Warehouse) -> DataFrame:
    """R11 variant B: year columns in, all one-hot slots, no word vector."""
    return _score_models(*indexed_features(wh, "B"), TREES_INDEXED, "indexed_b")


def hiring_model_hashed(wh: Warehouse) -> DataFrame:
    """Hashed features -> tree and 17-tree forest -> scores.

    Spark's tree learner bins every row into a dense ``int[numFeatures]``; at
    2^18 hashed buckets that is 1 MB per row. The slots of one text column exclude each other, so
    the trees read each text column as one ordered code of its hashed slot (``features.SlotBundles``, fitted on the training
    rows): 15 features per row, however many names the columns hold.
    """
    rows = fx.hash_split(models.materialize(model_rows(wh)), "row_key", TRAIN_TEST_HASHED, ["train", "test"])
    kinds = dict(rows.dtypes)
    names = [c for c in HASHED_INPUTS if kinds[c] == "string"]
    coded = fx.SlotBundles.fit(rows.where("split = 'train'"), names, "label").transform(rows)
    inputs = [c + "Code" if c in names else c for c in HASHED_INPUTS]
    return _score_models(*_train_test(fx.assemble(coded, inputs, "features")), TREES_HASHED, "hashed")


def feature_hash(wh: Warehouse) -> DataFrame:
    """M8: the 2^18-wide hashed vector per row as (row_key, size, indices, values)."""
    base = analog.client_features(wh).withColumn("row_key", F.col("order_id") * 16 + F.col("line_no"))
    return fx.sparse_vector_parts(fx.feature_hash(base, HASHED_INPUTS, "features"), "features", ["row_key"])


def word2vec(wh: Warehouse) -> DataFrame:
    """Education word lists -> mean word vector (100 dims)."""
    f = model_input(wh).withColumn("EducWords", analog.education_tokens(F.col("Educ")))
    f = fx.word2vec(f, "EducWords", "EducVec", min_count=5, num_partitions=W2V_PARTITIONS)
    return f.select("row_key", F.col("EducVec").alias("educ_vec"))


def _clustered(wh: Warehouse, keep: list[str] | None = None) -> DataFrame:
    """The cluster of every row of the model input: k-means (k = 4) on the hashed vectors, from farthest-first centres."""
    hashed = fx.feature_hash(model_rows(wh), HASHED_INPUTS, "features")
    hashed = fx.sparse_vector_parts(hashed, "features", ["row_key", *(keep or [])]).drop("size")
    points = spread(hashed, ["row_key"], spread_setting(wh.spark))  # kmeans writes them
    return clustering.kmeans(points, KMEANS_K, "row_key", keep, KMEANS_STEPS)


def kmeans(wh: Warehouse) -> DataFrame:
    """The cluster per row."""
    return _clustered(wh)


def cluster_profile(wh: Warehouse) -> DataFrame:
    """Year summaries per cluster, one aggregation pass for all clusters."""
    return summary_by_group(models.materialize(_clustered(wh, YEAR_INPUTS), "clusters"), "prediction", YEAR_INPUTS)


def cluster_values(wh: Warehouse) -> DataFrame:
    """The distinct clusters."""
    return distinct_of(_clustered(wh), ["prediction"])


def cluster_combinations(wh: Warehouse) -> DataFrame:
    """The distinct (branch, rank, label, cluster) combinations."""
    cols = ["Service_B", "Service_R", "label"]
    return distinct_of(_clustered(wh, cols), [*cols, "prediction"])


def cluster_overall(wh: Warehouse) -> DataFrame:
    """The year summaries over all clusters together."""
    return numeric_summary(_clustered(wh, YEAR_INPUTS), YEAR_INPUTS)


# ---- text model jobs ---------------------------------------------------------


def _tokenised_docs(wh: Warehouse) -> DataFrame:
    """Pages (the HTML posts) laid out by key first, then tokenised in parallel, then written.
    The tag of a page is the language it declares."""
    raw = spread(wh.pages.select("page_id", "html"), ["page_id"], spread_setting(wh.spark))
    d = raw.select(
        F.col("page_id").alias("doc_id"),
        F.regexp_extract("html", '<html lang="([a-z]*)"', 1).alias("oneTag"),
        regex_tokens("html").alias("Words"),
        pattern_count("html", text.PARAGRAPH_TAG).cast("double").alias("numParagraphs"),
        pattern_count("html", text.LINK_TAG).cast("double").alias("Linksnum"),
    ).withColumn("LenBody", F.size("Words").cast("double"))
    return models.fixed_layout(models.materialize(d), "doc_id")


def _tfidf_docs(docs: DataFrame) -> tuple[DataFrame, int]:
    """1500-term count vectors (deterministic vocabulary) -> IDF weights."""
    terms = docs.select("doc_id", F.explode("Words").alias("term"))
    vocab = [r["term"] for r in text.top_terms(terms, VOCAB_SIZE).collect()]  # k rows at most
    cv = CountVectorizerModel.from_vocabulary(vocab, inputCol="Words", outputCol="WordCount2")
    docs = cv.transform(docs)
    return IDF(inputCol="WordCount2", outputCol="tfidf").fit(docs).transform(docs), len(vocab)


def _pca(docs: DataFrame, width: int) -> DataFrame:
    return fx.pca(docs, "tfidf", "pcaFeatures", k=min(PCA_K, width), width=width)


def text_features(wh: Warehouse) -> DataFrame:
    """Tokens -> shape features -> scale; 1500-term counts -> IDF -> PCA(120);
    the tag indexed. Output (doc_id, tag_index, scaled shape, principal components)."""
    docs = _tokenised_docs(wh)
    docs = fx.assemble(docs, ["LenBody", "numParagraphs", "Linksnum"], "shape")
    docs = fx.standard_scale(docs, "shape", "scaledFeatures")
    docs, width = _tfidf_docs(docs)
    docs = fx.string_index(docs, ["oneTag"])
    docs = _pca(docs, width)
    return docs.select(
        "doc_id",
        F.col("oneTagIndex").alias("tag_index"),
        vector_to_array("scaledFeatures").alias("scaled_shape"),
        vector_to_array("pcaFeatures").alias("pca_features"),
    )


def pca(wh: Warehouse) -> DataFrame:
    """The principal components of the TF-IDF vectors."""
    docs, width = _tfidf_docs(_tokenised_docs(wh))
    return _pca(docs, width).select("doc_id", vector_to_array("pcaFeatures").alias("pca_features"))


def _labelled_docs(wh: Warehouse) -> DataFrame:
    d = wh.documents.select("doc_id", "text").join(
        wh.labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id"
    )
    return fx.hash_split(d, "doc_id", TRAIN_TEST, ["train", "test"])


def logistic_regression(wh: Warehouse) -> DataFrame:
    """Tokenizer -> HashingTF -> LogisticRegression(maxIter=10) on labelled documents."""
    d = _labelled_docs(wh)
    train = models.fixed_layout(models.materialize(d.filter(F.col("split") == "train")), "doc_id")
    pipeline, _, _ = models.text_classifier(max_iter=10)
    fitted = pipeline.fit(train)
    out = fitted.transform(d.filter(F.col("split") == "test"))
    return out.select("doc_id", "text", vector_to_array("probability").alias("probability"), "prediction")


def _grid(wh: Warehouse, keep_models: bool = False):
    """The labelled documents with fold numbers, their laid-out train part, and the grid fitted on it: 3 hash widths x 2 penalties, 3 folds."""
    d = _labelled_docs(wh).withColumn("fold", models.fold_column("doc_id", GRID_FOLDS))
    train = models.fixed_layout(models.materialize(d.filter(F.col("split") == "train")), "doc_id", rows_per_partition=GRID_ROWS)
    return d, train, models.grid_search(train, GRID_HASH_SIZES, GRID_REG_PARAMS, "fold", max_iter=10, keep_models=keep_models)


def grid_search(wh: Warehouse) -> DataFrame:
    """The best model's predictions on the held-out documents."""
    d, _, fitted = _grid(wh)
    out = fitted.bestModel.transform(d.filter(F.col("split") == "test"))
    return out.select("doc_id", vector_to_array("probability")[1].alias("prob_1"), "prediction")


def grid_table(wh: Warehouse) -> DataFrame:
    """The exact area under the curve of every fold, width and penalty, and which parameters are best."""
    _, train, fitted = _grid(wh, keep_models=True)
    return tuning.grid_table(train, fitted, "fold")
