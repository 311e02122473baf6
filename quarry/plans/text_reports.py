"""Text keys: word count (R14), tokenisers (M1, M2), vocabulary (O4, O5, M4),
TF-IDF (M5), page shape (F6-F8), hashed term frequencies (M3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import text
from quarry.operators.features import sparse_vector_parts
from quarry.operators.partitioning import spread, spread_setting
from quarry.sources.tables import Warehouse


def _documents(wh: Warehouse) -> DataFrame:
    return spread(wh.documents.select("doc_id", "text"), ["doc_id"], spread_setting(wh.spark))


def _doc_lines(wh: Warehouse) -> DataFrame:
    return text.lines_of(_documents(wh), "text")


def word_count(wh: Warehouse) -> DataFrame:
    """Word counts of every line of every document (split on one space)."""
    return text.word_count(_doc_lines(wh))


def word_count_java(wh: Warehouse) -> DataFrame:
    """R14, Java split rule."""
    return text.word_count_java(_doc_lines(wh))


def tokenize_regex(wh: Warehouse) -> DataFrame:
    """M2: (doc_id, pos, token), lower case, split on non-word characters."""
    return text.tokens_long(_documents(wh), "doc_id", text.regex_token_column("text"))


def tokenize_ws(wh: Warehouse) -> DataFrame:
    """M1: (doc_id, pos, token), lower case, split on one whitespace character."""
    return text.tokens_long(_documents(wh), "doc_id", text.whitespace_token_column("text"))


def _terms(wh: Warehouse) -> DataFrame:
    return text.doc_terms(_documents(wh), "doc_id", "text")


def top_terms(wh: Warehouse) -> DataFrame:
    """The 1500 most frequent terms of the corpus."""
    return text.top_terms(_terms(wh))


def rarest_kept_terms(wh: Warehouse) -> DataFrame:
    """The 5 least frequent of those 1500."""
    return text.rarest_kept_terms(_terms(wh))


def term_counts(wh: Warehouse) -> DataFrame:
    """M4: count vectors in long form (doc_id, term, n) over the 1500-term vocabulary."""
    counts = _counts(wh)
    return counts.join(F.broadcast(text.vocabulary(counts).select("term")), "term").select("doc_id", "term", "n")


def _counts(wh: Warehouse) -> DataFrame:
    return _terms(wh).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


def tfidf(wh: Warehouse) -> DataFrame:
    """M5: (doc_id, term, tf, idf, tfidf) with N = number of documents."""
    n_docs = wh.documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    return text.tfidf(_counts(wh), "doc_id", n_docs)


def text_shape(wh: Warehouse) -> DataFrame:
    """Token count, paragraph and link tags per page."""
    pages = spread(wh.pages.select("page_id", "html"), ["page_id"], spread_setting(wh.spark))
    return text.text_shape(pages, "page_id", "html")


def hashing_tf(wh: Warehouse) -> DataFrame:
    """M3: whitespace tokens hashed into 2^18 buckets: (doc_id, size, indices, values)."""
    d = _documents(wh).select("doc_id", text.whitespace_token_column("text").alias("words"))
    return sparse_vector_parts(text.hashing_tf(d, "words", "tf"), "tf", ["doc_id"])
