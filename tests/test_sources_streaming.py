import os
import tempfile
import time

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from quarry.sources import from_rows, jdbc_options, read_csv, read_json, read_text, schema_report
from quarry.streaming import read_word_counts, start_word_count, start_word_count_to_table
from quarry.operators import text


def test_headerless_csv_blanks_and_quoted_commas(spark):
    d = tempfile.mkdtemp(prefix="quarry-csv-")
    path = os.path.join(d, "m.csv")
    with open(path, "w") as fh:
        fh.write('0,GUESTROW,"1 Lane, Town",,x\n')
        fh.write('4,Someone,"2 Road, City",1,""\n')
    schema = StructType([
        StructField("memid", IntegerType()), StructField("name", StringType()),
        StructField("address", StringType()), StructField("rec", IntegerType()), StructField("note", StringType()),
    ])
    rows = read_csv(spark, path, schema=schema, header=False).orderBy("memid").collect()
    assert rows[0].address == "1 Lane, Town" and rows[0].rec is None
    assert rows[1].rec == 1 and rows[1].note is None  # "" reads as NULL


def test_csv_header_inference_is_opt_in(spark):
    d = tempfile.mkdtemp(prefix="quarry-csv-")
    path = os.path.join(d, "h.csv")
    with open(path, "w") as fh:
        fh.write("id,hired\n1,1\n2,No\n3,\n")
    typed = read_csv(spark, path, infer_schema=True)
    assert dict(typed.dtypes)["hired"] == "string"  # one dirty value keeps the label a string
    plain = read_csv(spark, path)
    assert dict(plain.dtypes)["id"] == "string"


def test_json_and_text(spark):
    d = tempfile.mkdtemp(prefix="quarry-json-")
    with open(os.path.join(d, "p.json"), "w") as fh:
        fh.write('{"Id": 115, "Body": "<p>a</p>", "oneTag": "x"}\n{"Id": 7, "Body": "b", "oneTag": "y"}\n')
    df = read_json(spark, d, schema="Id long, Body string, oneTag string")
    assert df.filter("Id = 115").first().Body == "<p>a</p>"
    t = tempfile.mkdtemp(prefix="quarry-text-")
    with open(os.path.join(t, "lines.txt"), "w") as fh:
        fh.write("a b\nb\n")
    counts = {r.word: r["count"] for r in text.word_count(read_text(spark, t).withColumnRenamed("value", "line")).collect()}
    assert counts == {"a": 1, "b": 2}


def test_jdbc_options_partitioned_and_validated():
    opts = jdbc_options("jdbc:postgresql://host/db", "t", user="u", password="p",
                        partition_column="id", lower_bound=0, upper_bound=1000, num_partitions=8)
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_literal_rows_are_bounded(spark):
    with pytest.raises(ValueError):
        from_rows(spark, [(i,) for i in range(11)], ["x"], max_rows=10)
    assert from_rows(spark, [(1, "a")], "x int, y string").count() == 1


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    rows = schema_report(spark, {"t": df}).collect()
    assert [(r.position, r.column_name, r.data_type) for r in rows] == [(1, "x", "int"), (2, "y", "string")]


def test_streaming_word_count_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="quarry-stream-in-")
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("x y x\n\n")
    q = start_word_count(spark, src, "wc_stream_test", checkpoint_dir=tempfile.mkdtemp(prefix="quarry-stream-ck-"))
    try:
        q.processAllAvailable()
        with open(os.path.join(src, "b.txt"), "w") as fh:
            fh.write("y z\n")
        time.sleep(1)
        q.processAllAvailable()
        got = {r.word: r["count"] for r in spark.sql("SELECT * FROM wc_stream_test").collect()}
    finally:
        q.stop()
    batch = {r.word: r["count"] for r in text.word_count(read_text(spark, src).withColumnRenamed("value", "line")).collect()}
    assert got == batch == {"x": 2, "y": 2, "z": 1, "": 1}


def test_streaming_word_count_into_a_table_resumes_from_checkpoint(spark):
    src = tempfile.mkdtemp(prefix="quarry-stream-in-")
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-stream-out-"), "counts")
    ckpt = tempfile.mkdtemp(prefix="quarry-stream-ck-")
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("p q p\n")
    q = start_word_count_to_table(spark, src, out, checkpoint_dir=ckpt)
    q.processAllAvailable()
    q.stop()
    # a new query on the same checkpoint picks up only the new file, keeping the state
    with open(os.path.join(src, "b.txt"), "w") as fh:
        fh.write("q r\n")
    q = start_word_count_to_table(spark, src, out, checkpoint_dir=ckpt)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.word: r["count"] for r in read_word_counts(spark, out).collect()}
    assert got == {"p": 2, "q": 2, "r": 1}
    left = sorted(d for d in os.listdir(out) if d.startswith("version="))
    assert len(left) == 1
    os.mkdir(os.path.join(out, "version=99"))  # a writer that died before its version was complete
    assert {r.word: r["count"] for r in read_word_counts(spark, out).collect()} == got
