"""Ranked lexical search over a length-stratified index, in whole numbers.

Terms are the runs of ASCII letters, digits and non-ASCII characters of the whole text, ``A-Z`` in
lower case. A document of n terms has the normaliser ``m = 10 + (90 * n * N) div L`` (N documents
with a term, L terms in all). A term found tf times adds
``weight * ((10 ** 9 * tf) div (1000 * tf + 8 * m))`` to a document's score, with
``weight = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``.

Index. Documents of equal m form a stratum; a stratum of more documents than ``PIECE_DOCS``, or
of more terms than ``PIECE_TERMS``, is dealt to pieces by place in the input, so no task holds a large
stratum. A piece is one row: its documents, and postings grouped by (term, tf). All
documents of a piece share m, so an impact is computed once per (term, tf) and serves all of
its postings. The index is a written table and holds every document with a term.

Search. Queries come in blocks of bounded term number; a block is sent to the tasks, every piece
is read once per block. For each piece and query the sum of weight times best impact bounds the
scores in the piece. A task visits its pieces for a query from the highest bound down and stops at the first
bound below its k-th best score; equal bounds are visited, so ties are whole. The tasks' lists
(k entries per query) meet in two steps.

Terms are compared by a 64-bit hash of their bytes. Nulls, ties, repeats: a null text or one without terms is
no document and a query without terms has no results; each row is a document; rows of queries that share
an id (null is one) are one query with the terms of all; ties go to the smaller document id, null first. Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.bytes_np import IS_WORD, LOWER, Spans, text_slices
from quarry.operators.models import materialize

PIECE_DOCS, PIECE_TERMS = 256, 1 << 20
BLOCK_TERMS = 1 << 16
HELD_PIECES = 64
MERGE = 64

#: As arrays: term and tf of each posting group, where its documents start, the documents (places in ``ids``).
INDEX = "m long, ids array<long>, terms array<long>, tfs array<int>, starts array<int>, docs array<int>"


def _counted(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``first row, end row, rows, terms, tfs, n`` per slice of texts; rows ascend, terms ascend within a row."""
    for lo, hi, data, offsets in text_slices(batch.column("text")):
        words = Spans(LOWER[data], offsets, IS_WORD)
        order = np.lexsort((words.hash, words.row))
        rows, terms = words.row[order], words.hash[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])
        at = np.flatnonzero(new)
        tfs = np.diff(np.append(at, len(rows)))
        yield lo, hi, rows[at], terms[at].view(np.int64), tfs, np.bincount(words.row, minlength=hi - lo)


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, n, terms, tfs`` of the texts that have a term."""
    for batch in batches:
        for lo, hi, rows, terms, tfs, n in _counted(batch):
            has = np.flatnonzero(n)
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=hi - lo)[has])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(lo, hi - lo).take(pa.array(has)), pa.array(n[has].astype(np.int64)),
                    pa.ListArray.from_arrays(ends, pa.array(terms)), pa.ListArray.from_arrays(ends, pa.array(tfs.astype(np.int32))),
                ],
                ["id", "n", "terms", "tfs"],
            )


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``n, docs``: how many texts of the batch have n terms."""
    for batch in batches:
        for lo, hi, data, offsets in text_slices(batch.column("text")):
            inside = IS_WORD[data]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            starts = offsets[:-1][offsets[:-1] < len(data)]
            first[starts] = inside[starts]
            n, docs = np.unique(np.diff(np.concatenate([[0], np.cumsum(first)])[offsets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64))], ["n", "docs"])


def _piece(key: tuple, table: pa.Table) -> pa.Table:
    """The index row of one piece."""
    table = table.combine_chunks()
    flat = lambda name: np.concatenate([np.zeros(0, np.int64), *[c.flatten().to_numpy() for c in table.column(name).chunks]])
    lengths = np.concatenate([np.diff(c.offsets.to_numpy()) for c in table.column("terms").chunks])
    doc, terms, tfs = np.repeat(np.arange(len(lengths)), lengths), flat("terms"), flat("tfs")
    order = np.lexsort((doc, -tfs, terms))
    doc, terms, tfs = doc[order], terms[order], tfs[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])
    at = np.flatnonzero(new)
    one = lambda values, kind: pa.array([values.astype(kind)])
    ids = pa.array([table.column("id").to_pylist()], pa.list_(pa.int64()))
    return pa.table({
        "m": pa.array([key[0].as_py()], pa.int64()), "ids": ids, "terms": one(terms[at], np.int64), "tfs": one(tfs[at], np.int32),
        "starts": one(np.append(at, len(terms)), np.int32), "docs": one(doc, np.int32),
    })


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int, int]:
    """The written index (``INDEX``), N and L."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    sizes = materialize(
        texts.select("text").mapInArrow(_sizes, "n long, docs long").where("n > 0").groupBy("n").agg(F.sum("docs").alias("docs")), "lexical-sizes"
    )
    total = sizes.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    m = F.expr(f"10 + (90 * n * {n_docs}L) div {max(1, n_terms)}L")
    pieces = F.greatest(F.ceil(F.col("docs") / PIECE_DOCS), F.ceil(F.col("terms") / PIECE_TERMS))
    large = (
        sizes.groupBy(m.alias("m")).agg(F.sum("docs").alias("docs"), F.sum(F.col("n") * F.col("docs")).alias("terms"))
        .select("m", pieces.cast("long").alias("pieces")).where("pieces > 1")
    )
    rows = texts.mapInArrow(_term_rows, "id long, n long, terms array<long>, tfs array<int>")
    rows = rows.withColumns({"m": m, "at": F.xxhash64(F.monotonically_increasing_id())})
    number = F.pmod("at", F.coalesce("pieces", F.lit(1)))
    dealt = rows.join(large, "m", "left").select("m", number.alias("piece"), "id", "terms", "tfs")
    index = dealt.groupBy("m", "piece").applyInArrow(_piece, INDEX)
    return materialize(index, "lexical-index"), n_docs, n_terms


def _frequencies(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column("terms"), batch.column("starts")):
                place, found, _ = _meet(vocabulary, terms.values.to_numpy())
                np.add.at(df, place, np.diff(starts.values.to_numpy())[found])
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["place", "df"])

    return run


def _meet(vocabulary: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the posting groups whose term is in the (ascending) vocabulary: its place there, theirs, and whether it is the term's first."""
    place = np.searchsorted(vocabulary, terms)
    found = np.flatnonzero((place < len(vocabulary)) & (vocabulary[np.minimum(place, len(vocabulary) - 1)] == terms))
    place = place[found]
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]
    return place, found, first


class _Queries:
    """A block of queries: ids, and as arrays their (query, term) pairs with terms as places in a vocabulary."""

    def __init__(self, ids: list[int | None], terms: list[list[int]]) -> None:
        self.ids = ids
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *[np.array(t, np.int64) for t in terms]])
        self.vocabulary, self.place = np.unique(flat, return_inverse=True)
        self.weights = np.zeros(len(self.vocabulary), np.int64)

    def places(self, query: int) -> np.ndarray:
        return self.place[self.starts[query] : self.starts[query + 1]]


class _Piece:
    """The part of an index row that a block of queries meets; points are weight times impact."""

    def __init__(self, batch: pa.RecordBatch, row: int, queries: _Queries) -> None:
        m = batch.column("m")[row].as_py()
        terms, tfs, starts, docs = (batch.column(c)[row].values.to_numpy() for c in ("terms", "tfs", "starts", "docs"))
        ids = batch.column("ids")[row].values
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        place, found, first = _meet(queries.vocabulary, terms)
        tfs = tfs[found].astype(np.int64)
        points = (10**9 * tfs) // (1000 * tfs + 8 * m) * queries.weights[place]
        best = np.zeros(len(queries.vocabulary), np.int64)
        best[place[first]] = points[first]  # a term's groups stand by falling tf
        self.bounds = np.add.reduceat(best[queries.place], queries.starts[:-1])
        lengths = (starts[1:] - starts[:-1])[found]
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.docs = docs[np.repeat(starts[:-1][found], lengths) + inside]
        self.points = np.repeat(points, lengths)
        self.ends = np.cumsum(np.bincount(place, weights=lengths, minlength=len(best)).astype(np.int64))

    def scores(self, places: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.ids), np.int64)
        for p in places:
            a, b = self.ends[p - 1] if p else 0, self.ends[p]
            total[self.docs[a:b]] += self.points[a:b]  # a document occurs once per term
        return total


class _Top:
    """The k best documents of a query so far: by falling score, then null id, then rising id."""

    def __init__(self, k: int) -> None:
        self.k, self.ids, self.known, self.scores = k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def least(self) -> int:
        """What a document must score to enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, piece: _Piece, places: np.ndarray) -> None:
        own = piece.scores(places)
        some = np.flatnonzero(own >= self.least())
        ids, known = np.concatenate([self.ids, piece.ids[some]]), np.concatenate([self.known, piece.known[some]])
        scores = np.concatenate([self.scores, own[some]])
        top = np.lexsort((ids, known, -scores))[: self.k]
        self.ids, self.known, self.scores = ids[top], known[top], scores[top]


def _searched(queries: _Queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [_Top(k) for _ in queries.ids]

        def visit(pieces: list[_Piece]) -> None:
            bounds = np.array([p.bounds for p in pieces])
            order = np.argsort(-bounds, axis=0, kind="stable")
            for q, top in enumerate(tops):
                for i in order[:, q]:
                    if bounds[i, q] < top.least():
                        break
                    top.add(pieces[i], queries.places(q))

        held: list[_Piece] = []
        for batch in batches:
            for row in range(batch.num_rows):
                held.append(_Piece(batch, row, queries))
                if len(held) == HELD_PIECES:
                    visit(held)
                    held = []
        if held:
            visit(held)
        for item, top in zip(queries.ids, tops):
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(top.ids), pa.int64()), pa.array(top.ids, mask=~top.known), pa.array(top.scores)],
                ["item_id", "doc_id", "score"],
            )

    return run


def _query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, terms``: the different terms of every query that has one."""
    texts = items.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    pairs = texts.mapInArrow(_term_rows, "id long, n long, terms array<long>, tfs array<int>").select(F.col("id").alias("item_id"), F.explode("terms").alias("term"))
    return pairs.distinct().groupBy("item_id").agg(F.collect_list("term").alias("terms"))


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of score above 0 for every item."""
    spark = docs.sparkSession
    index, n_docs, _ = build_index(docs, id_col, text_col)
    queries = materialize(_query_terms(items, item_col, text_col), "lexical-queries")
    pairs = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-pairs // BLOCK_TERMS))
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for b in range(n_blocks):
        rows = queries.where(block == b).collect()  # about BLOCK_TERMS terms
        if not rows:
            continue
        some = _Queries([r.item_id for r in rows], [r.terms for r in rows])
        per_task = index.select("terms", "starts").mapInArrow(_frequencies(some.vocabulary), "place long, df long")
        for place, df in per_task.groupBy("place").agg(F.sum("df")).collect():  # a row per term of the block
            some.weights[place] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        found = found.union(index.mapInArrow(_searched(some, k), "item_id long, doc_id long, score long"))
    best = found.withColumn("part", F.spark_partition_id() % MERGE)
    for keys in (["item_id", "part"], ["item_id"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
