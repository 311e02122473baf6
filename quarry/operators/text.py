"""Text operators: lines, word counts, tokens, vocabulary, term counts, TF-IDF.

Everything is expressed with built-in functions (``split``, ``explode``,
``regexp_count``) so tokenising runs inside codegen and counts use
partial (map-side) aggregation: a word that holds a third of all tokens still
leaves each map task as a single partial count.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import (
    java_space_split,
    pattern_count,
    r6,
    regex_tokens,
    split_keep_empty,
    whitespace_tokens,
)
from quarry.operators.relational import top_k_by_count

# The tokeniser pattern of the text-mining job and the HTML tags it counts.
WORD_SPLIT_PATTERN = r"\W"
PARAGRAPH_TAG = "</p>"
LINK_TAG = "</a>"
DEFAULT_VOCAB_SIZE = 1500
DEFAULT_HASH_FEATURES = 1 << 18


def lines_of(df: DataFrame, text_col: str, id_col: str | None = None) -> DataFrame:
    """One row per line of a text column, as a text-file scan yields them: lines end at ``\\r\\n``,
    ``\\r`` or ``\\n``; empty lines are kept, but nothing follows the last line end."""
    keep = [id_col] if id_col else []
    pieces = F.split(F.col(text_col), "\r\n|\r|\n", -1)
    lines = F.when(F.element_at(pieces, -1) == "", F.slice(pieces, 1, F.size(pieces) - 1)).otherwise(pieces)
    return df.select(*keep, F.explode(lines).alias("line"))


def word_count(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """(word, count) with words from splitting each line on one space, empty words kept."""
    words = lines.select(F.explode(split_keep_empty(line_col, " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_count_java(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """(word, count) with the ``Pattern.split`` rule (trailing empty words dropped)."""
    words = lines.select(F.explode(java_space_split(line_col)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def tokens_long(df: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """(id, pos, token): an array-of-tokens expression in long form."""
    return df.select(id_col, F.posexplode(tokens).alias("pos", "token")).select(
        id_col, F.col("pos").cast("bigint").alias("pos"), "token"
    )


def regex_token_column(text_col: str, pattern: str = WORD_SPLIT_PATTERN) -> Column:
    return regex_tokens(text_col, pattern)


def whitespace_token_column(text_col: str) -> Column:
    return whitespace_tokens(text_col)


def doc_terms(docs: DataFrame, id_col: str, text_col: str, pattern: str = WORD_SPLIT_PATTERN) -> DataFrame:
    """(id, term): every regex token occurrence."""
    return docs.select(id_col, F.explode(regex_tokens(text_col, pattern)).alias("term"))


def term_totals(terms: DataFrame) -> DataFrame:
    """(term, count): corpus frequency of each term."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def top_terms(terms: DataFrame, k: int = DEFAULT_VOCAB_SIZE) -> DataFrame:
    """The vocabulary: k most frequent terms, ties by term (a k-row, bounded result)."""
    return top_k_by_count(term_totals(terms), "term", "count", k)


def rarest_kept_terms(terms: DataFrame, k: int = DEFAULT_VOCAB_SIZE, n: int = 5) -> DataFrame:
    """The last n terms of the k-term vocabulary."""
    vocab = top_terms(terms, k)
    return vocab.orderBy(F.col("count").asc(), F.col("term").desc()).limit(n)


def term_counts(terms: DataFrame, id_col: str, vocab: DataFrame) -> DataFrame:
    """(id, term, n): count vectors in long form, restricted to the vocabulary.

    The vocabulary has at most k rows by construction, so broadcasting it is
    safe at any corpus size; token occurrences are never shuffled whole, only
    their per-(doc, term) partial counts.
    """
    kept = terms.join(F.broadcast(vocab.select("term")), "term")
    return kept.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(counts: DataFrame, k: int = DEFAULT_VOCAB_SIZE) -> DataFrame:
    """(term, count, df): the k most frequent terms of ``counts`` (id, term, n: one row per document and
    term), with the number of documents that hold them; ties by term."""
    totals = counts.groupBy("term").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("df"))
    return totals.orderBy(F.desc("count"), F.asc("term")).limit(k)


def tfidf(counts: DataFrame, id_col: str, n_docs: Column, k: int = DEFAULT_VOCAB_SIZE) -> DataFrame:
    """(id, term, tf, idf, tfidf) in long form over the k-term vocabulary of ``counts`` (id, term, n).

    ``idf = ln((N + 1) / (df + 1))`` as in ``pyspark.ml.feature.IDF``; ``n_docs`` may be a scalar
    subquery. Both uses of ``counts`` read one aggregate; the vocabulary has at most k rows.
    """
    idf = vocabulary(counts, k).select("term", F.log((n_docs + 1.0) / (F.col("df") + 1.0)).alias("idf"))
    joined = counts.join(F.broadcast(idf), "term")
    return joined.select(
        id_col,
        "term",
        F.col("n").alias("tf"),
        r6(F.col("idf")).alias("idf"),
        r6(F.col("n") * F.col("idf")).alias("tfidf"),
    )


def text_shape(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, len_body, num_paragraphs, num_links): token count and tag counts."""
    return df.select(
        id_col,
        F.size(regex_tokens(html_col)).cast("bigint").alias("len_body"),
        pattern_count(html_col, PARAGRAPH_TAG).alias("num_paragraphs"),
        pattern_count(html_col, LINK_TAG).alias("num_links"),
    )


def hashing_tf(df: DataFrame, tokens_col: str, output_col: str = "tf",
               num_features: int = DEFAULT_HASH_FEATURES) -> DataFrame:
    """Term frequencies hashed into ``num_features`` buckets (``HashingTF``).

    The bucket is Murmur3 (seed 42) of the UTF-8 term modulo ``num_features``;
    Spark ML uses the corrected Murmur3 tail, so SQL ``hash()`` does not give
    the same buckets and the transformer itself is used.
    """
    return HashingTF(inputCol=tokens_col, outputCol=output_col, numFeatures=num_features).transform(df)
