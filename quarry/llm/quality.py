"""Quality classifier by importance resampling.

Two bag-of-n-grams models over hashed buckets (words and word pairs) are counted: one of the
target text (documents labelled as good quality and not as toxic), one of all raw text. A document's log importance is the sum over its n-grams of log(target share / raw share).
Adding Gumbel noise to it and keeping the largest k draws k documents without replacement in
proportion to their importance. k is the share of target documents among all labelled ones,
times the number of documents, unless given.

The raw counts cover all documents and whole texts. The target counts use the labelled rows
in a sample of at most ``MAX_LABELLED`` ids (the smallest by hash of the id), a stated bound,
so their ids can be broadcast. Counts per bucket are dense arrays of ``buckets`` numbers,
summed by Spark; the driver holds two such arrays, whatever the input.

Nulls and ties: a null or empty text has importance 0; a null id is never labelled; noise is
a hash of the id, so reruns agree; ties of the noisy score are ordered by id and text hash.
Labels that disagree for an id make it no target. With no labelled target, nothing tells
texts apart: all importances are 0 and every document is kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bytes_np import IS_SPACE, LOWER, Spans, text_slices
from quarry.operators.models import materialize
from quarry.operators.ranking import with_position
from quarry.operators.sampling import fresh

BUCKETS = 1 << 15
MAX_LABELLED = 20_000
SMOOTHING = 1.0


def _buckets(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every word and word pair of a slice; capitals count as they are."""
    n_rows = len(offsets) - 1
    spans = Spans(data, offsets, ~IS_SPACE)
    pair_row, pair = spans.grams(2, n_rows)
    rows = np.concatenate([spans.row, pair_row])
    hashes = np.concatenate([spans.hash, pair])
    return rows, (hashes % np.uint64(buckets)).astype(np.int64)


def _count(buckets: int):
    schema = pa.schema([("target", pa.bool_()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            is_target = np.array(batch.column(1).to_pylist(), bool)
            for lo, hi, data, offsets in text_slices(batch.column(0)):
                rows, where = _buckets(data, offsets, buckets)
                raw += np.bincount(where, minlength=buckets)
                target += np.bincount(where[is_target[lo:hi][rows]], minlength=buckets)
        for flag, counts in ((False, raw), (True, target)):
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), flag)), pa.array(some, pa.int32()), pa.array(counts[some])], schema=schema
            )

    return run


def _score(model, n_buckets: int, passed: pa.Schema):
    schema = pa.schema([*passed, ("importance", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = model.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, hi, data, offsets in text_slices(batch.column(0)):
                rows, where = _buckets(data, offsets, n_buckets)
                out[lo:hi] = np.bincount(rows, ratio[where], minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out)], schema=schema)

    return run


def target_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, target`` of all labelled ids: good quality and not toxic (null: not) in every row of the id."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)
    return (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min(good.cast("int")).cast("boolean").alias("target"))
    )


def importances(
    docs: DataFrame, labelled: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text_hash, importance`` of every document; ``labelled``: ``doc_id, target``, bounded."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"))
    target = F.broadcast(labelled.where("target").select("doc_id", F.lit(True).alias("target")))  # <= MAX_LABELLED ids
    counts = (
        texts.join(target, "doc_id", "left")
        .select("text", F.coalesce("target", F.lit(False)).alias("target"))
        .mapInArrow(_count(buckets), "target boolean, bucket int, n long")
        .groupBy("target", "bucket")
        .agg(F.sum("n").alias("n"))
    ).toPandas()  # 2 * buckets rows at most
    dense = {flag: np.zeros(buckets) for flag in (True, False)}
    for flag, some in counts.groupby("target"):
        dense[bool(flag)][some["bucket"].to_numpy()] = some["n"].to_numpy()
    if dense[True].sum():
        share = {k: (v + SMOOTHING) / (v + SMOOTHING).sum() for k, v in dense.items()}
        ratio = np.log(share[True] / share[False])
    else:
        ratio = np.zeros(buckets)
    model = spark.sparkContext.broadcast(ratio)  # buckets numbers
    kind = docs.schema[id_col].dataType.simpleString()
    passed = pa.schema([("doc_id", {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]), ("text_hash", pa.int64())])
    return texts.select("text", "doc_id", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _score(model, buckets, passed), f"doc_id {kind}, text_hash long, importance double"
    )


def resample(
    docs: DataFrame,
    labels: DataFrame,
    keep: int | None = None,
    buckets: int = BUCKETS,
    seed: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """The drawn documents: ``doc_id, text_hash, importance, noisy, place`` (place 0 drawn first)."""
    labelled = materialize(target_labels(labels), "quality-labels")
    sample = materialize(labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled), "quality-sample")
    scored = materialize(importances(docs, sample, buckets, id_col, text_col), "quality-scores")
    if keep is None:
        n, n_labelled, n_target = (
            scored.count(), *labelled.agg(F.count(F.lit(1)), F.count(F.when(F.col("target"), 1))).first(),
        )
        keep = n if not n_target else -(-n * n_target // n_labelled)
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40))
    noisy = scored.withColumn("noisy", F.col("importance") - F.log(-F.log(u)))
    order = [F.desc("noisy"), F.asc_nulls_last("doc_id"), F.col("text_hash")]
    return with_position(noisy, order, "place").where(F.col("place") < keep)


def keep_resampled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that :func:`resample` draws, all columns; repeated rows are drawn alike."""
    drawn = resample(docs, labels, id_col=id_col, text_col=text_col, **options).select("doc_id", "text_hash").distinct()
    id_name, text_name = fresh("drawn_id", docs.columns), fresh("drawn_text", docs.columns)
    drawn = materialize(drawn, "quality-drawn").toDF(id_name, text_name)
    same = F.col(id_col).eqNullSafe(F.col(id_name)) & (F.xxhash64(text_col) == F.col(text_name))
    return docs.join(drawn, same, "left_semi")
