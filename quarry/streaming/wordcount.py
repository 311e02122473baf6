"""Incremental word count over text files arriving in a folder.

The same plan as the batch word count (split on one space, count per word);
Structured Streaming keeps the running counts in its state store, and the
checkpoint (in the shared folder) lets a restarted query resume exactly where
it stopped after a driver or executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.text import word_count, word_count_java
from quarry.session import hadoop_fs, remove_scratch, scratch_path


def word_count_stream(spark: SparkSession, input_dir: str, rule: str = "python",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (word, count) over every line of the files in ``input_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(input_dir).withColumnRenamed("value", "line")
    return word_count_java(lines) if rule == "java" else word_count(lines)


def start_word_count(spark: SparkSession, input_dir: str, query_name: str,
                     checkpoint_dir: str | None = None, rule: str = "python") -> StreamingQuery:
    """Run the stream into an in-memory table ``query_name`` (complete mode).

    For a durable sink use ``foreachBatch`` to merge each batch into a table;
    the memory sink is for tests and small result sets.
    """
    counts = word_count_stream(spark, input_dir, rule)
    ckpt = checkpoint_dir or scratch_path(spark, f"stream-{query_name}")
    return (
        counts.writeStream.outputMode("complete")
        .format("memory")
        .queryName(query_name)
        .option("checkpointLocation", ckpt)
        .start()
    )


def _versions(spark: SparkSession, table_path: str) -> list[tuple[int, bool]]:
    """Batch number of every version below ``table_path``, and whether it is complete."""
    fs, path = hadoop_fs(spark, table_path), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(path(table_path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(table_path))]
    numbers = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    return sorted((n, fs.exists(path(f"{table_path}/version={n}/_SUCCESS"))) for n in numbers)


def read_word_counts(spark: SparkSession, table_path: str) -> DataFrame:
    """(word, count) of the newest complete version that ``start_word_count_to_table`` wrote."""
    complete = [n for n, done in _versions(spark, table_path) if done]
    if not complete:
        raise FileNotFoundError(f"no complete version below {table_path}")
    return spark.read.parquet(f"{table_path}/version={complete[-1]}")


def start_word_count_to_table(spark: SparkSession, input_dir: str, table_path: str,
                              checkpoint_dir: str | None = None, rule: str = "python") -> StreamingQuery:
    """Run the stream into parquet (complete counts, a new version per trigger; see ``read_word_counts``).

    Each micro-batch of a complete-mode aggregation holds every (word, count),
    which is bounded by the vocabulary, not by the input. A version is written beside the last one, and older ones are
    removed once it is complete, so a crash at any point leaves a complete version. A batch replayed after a
    failure writes its version anew with the same rows; with the query checkpoint in the shared folder the stream resumes
    where it stopped.
    """
    counts = word_count_stream(spark, input_dir, rule)
    ckpt = checkpoint_dir or scratch_path(spark, "stream-table")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/version={batch_id}")
        remove_scratch(spark, [f"{table_path}/version={n}" for n, _ in _versions(spark, table_path) if n < batch_id])

    return (
        counts.writeStream.outputMode("complete")
        .foreachBatch(write_batch)
        .option("checkpointLocation", ckpt)
        .start()
    )
