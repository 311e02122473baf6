import math
import re

import pytest
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.operators import text

LINES = ["the cat  sat", "", "   ", "on the mat ", " the end"]


def test_word_count_python_and_java_rules(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "line string")
    py = {r.word: r["count"] for r in text.word_count(lines).collect()}
    expect = {}
    for x in LINES:
        for w in x.split(" "):
            expect[w] = expect.get(w, 0) + 1
    assert py == expect
    java = {r.word: r["count"] for r in text.word_count_java(lines).collect()}
    # Pattern.split: trailing empties dropped, an all-space line gives nothing,
    # an empty line gives one empty word.
    assert java == {"the": 3, "cat": 1, "": 3, "sat": 1, "on": 1, "mat": 1, "end": 1}


def _docs(spark):
    rows = [(1, "Spark spark data. Data!"), (2, "data lake, data"), (3, "nothing here"), (4, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_vocabulary_term_counts_and_tfidf_match_pyspark_ml(spark):
    docs = _docs(spark)
    terms = text.doc_terms(docs, "doc_id", "text")
    vocab = text.top_terms(terms, 3)
    assert [(r.term, r["count"]) for r in vocab.collect()] == [("data", 4), ("spark", 2), ("here", 1)]
    counts = text.term_counts(terms, "doc_id", vocab)
    tfidf = {(r.doc_id, r.term): r for r in text.tfidf(counts, "doc_id", F.lit(docs.count()), 3).collect()}

    words = docs.select("doc_id", text.regex_token_column("text").alias("w"))
    cv = CountVectorizerModel.from_vocabulary([r.term for r in vocab.collect()], inputCol="w", outputCol="tf")
    vec = IDF(inputCol="tf", outputCol="x").fit(cv.transform(words)).transform(cv.transform(words))
    vocab_list = [r.term for r in vocab.collect()]
    for r in vec.select("doc_id", vector_to_array("tf").alias("tf"), vector_to_array("x").alias("x")).collect():
        for i, term in enumerate(vocab_list):
            if r.tf[i] == 0:
                assert (r.doc_id, term) not in tfidf
            else:
                got = tfidf[(r.doc_id, term)]
                assert got.tf == r.tf[i]
                assert got.tfidf == pytest.approx(r.x[i], abs=1e-6)


def test_idf_formula(spark):
    docs = _docs(spark)
    terms = text.doc_terms(docs, "doc_id", "text")
    counts = text.term_counts(terms, "doc_id", text.top_terms(terms, 10))
    assert {r.term: r.df for r in text.vocabulary(counts).collect()}["data"] == 2
    idf = {r.term: r.idf for r in text.tfidf(counts, "doc_id", F.lit(4)).collect()}
    assert idf["data"] == pytest.approx(math.log(5 / 3), abs=1e-6)
    assert idf["lake"] == pytest.approx(math.log(5 / 2), abs=1e-6)


def test_rarest_kept_terms(spark):
    terms = text.doc_terms(_docs(spark), "doc_id", "text")
    got = [r.term for r in text.rarest_kept_terms(terms, 4, 2).collect()]
    # top 4: data(4) spark(2) here(1) lake(1); last two, rarest first, later term first
    assert got == ["lake", "here"]


def test_text_shape(spark):
    pages = spark.createDataFrame([(1, "<p>Hi there</p><p><a href='x'>go</a></p>")], "page_id long, html string")
    r = text.text_shape(pages, "page_id", "html").first()
    assert (r.num_paragraphs, r.num_links) == (2, 1)
    html = pages.first().html
    assert r.len_body == len([t for t in re.split(r"\W", html.lower(), flags=re.ASCII) if t]) == 11


def test_hashing_tf_counts_terms(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"])], "id int, w array<string>")
    v = text.hashing_tf(df, "w", "tf", 1 << 18).first().tf
    assert sorted(v.values.tolist()) == [1.0, 2.0]


def test_lines_of_keeps_empty_lines(spark):
    df = spark.createDataFrame([("a\n\nb",)], "t string")
    assert [r.line for r in text.lines_of(df, "t").collect()] == ["a", "", "b"]
