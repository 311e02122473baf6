"""N-gram Jaccard join of documents by chosen paths.

A document is its set of five-word shingles (words: runs of ASCII letters and digits and of
all other characters, capitals folded; one to four words are one shingle). Two documents are
linked if the Jaccard similarity of their sets is 0.8 or more; classes are the connected
groups of links.

1. Each text becomes a set name (128 bits), its size and a sketch of ``COORDINATES`` minhash
   values. Equal sets are one node from here on, with a weight.
2. Chosen path: every run samples a sketch coordinate and puts each node in the bucket of
   its value there. Buckets of more than ``SMALL`` nodes are split again and again on
   coordinates sampled by a hash of the bucket's own path (1.25 on average, the inverse of the
   threshold), so
   similar nodes keep meeting while others part. Small buckets are compared in full on the
   sketches; what still holds together after ``DEPTH`` splits shares so many values that it is
   taken as alike. ``RUNS`` independent runs give a pair of similarity 0.8 a chance of over
   0.999 of being found (measured in the tests against all pairs).
3. The groups so found are supersets of the classes. Inside them every pair of nodes is
   checked on the full shingle sets, in tiles of two blocks, as matrix products. A tile
   returns one row per node (its links, and a spanning star of the linked nodes), never pairs.
4. Connected components of the stars give the classes; documents get them by their set name.

Nulls and ties: null, empty and wordless texts have no shingles, are linked to nothing and
form a class of their own. ``class_id`` is the smallest document id of the class; null ids
are not taken as smallest unless the class has no other. Repeated rows are copies of one
another. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bytes_np import IS_WORD, LOWER, Spans, mix64, text_slices
from quarry.llm.graph import components, spanning_stars
from quarry.operators.models import materialize
from quarry.operators.ranking import with_position
from quarry.operators.sampling import fresh

WORDS, THRESHOLD = 5, 0.8
COORDINATES, RUNS, DEPTH, SMALL, TILE = 64, 16, 4, 64, 512
LOOSE = 0.2  # sketches may show a similarity this much below the threshold (four standard errors)
_ODD = np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each text's distinct shingles, sorted by row and hash."""
    n_rows = len(offsets) - 1
    spans = Spans(LOWER[data], offsets, IS_WORD)
    rows, hashes = spans.grams(words, n_rows)
    n_words = np.bincount(spans.row, minlength=n_rows)
    short = np.flatnonzero((n_words > 0) & (n_words < words))
    if len(short):
        ends = np.cumsum(n_words)
        extra = [
            np.bitwise_xor.reduce(mix64(spans.hash[ends[r] - n_words[r] : ends[r]] * np.arange(1, 2 * n_words[r], 2, dtype=np.uint64)))
            for r in short
        ]
        rows = np.concatenate([rows, short])
        hashes = np.concatenate([hashes, mix64(np.array(extra, np.uint64) + n_words[short].astype(np.uint64))])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def _multipliers(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | _ODD


def _names(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set's hashes."""
    return (
        np.add.reduceat(mix64(hashes + np.uint64(11)), starts).view(np.int64),
        np.add.reduceat(mix64(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts).view(np.int64),
    )


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, doc_id, text_hash -> doc_id, text_hash, n, s1, s2, sketch."""
    times = _multipliers(COORDINATES)
    schema = None
    for batch in batches:
        schema = schema or pa.schema([
            ("doc_id", batch.schema.field(1).type), ("text_hash", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()), ("sketch", pa.list_(pa.int32())),
        ])
        for lo, hi, data, offsets in text_slices(batch.column(0)):
            rows, hashes = shingles(data, offsets)
            size = np.bincount(rows, minlength=hi - lo)
            s1, s2 = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
            values = np.zeros((hi - lo, COORDINATES), np.uint32)
            full = np.flatnonzero(size)
            if len(full):
                starts = (np.cumsum(size) - size)[full]
                s1[full], s2[full] = _names(hashes, starts)
                for t in range(COORDINATES):
                    values[full, t] = np.minimum.reduceat((hashes * times[t]) >> np.uint64(32), starts)
            ends = np.arange(0, (hi - lo + 1) * COORDINATES, COORDINATES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(size, pa.int32()), pa.array(s1), pa.array(s2),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int32).ravel())),
                ],
                schema=schema,
            )


def _by_key(batches: Iterator[pa.RecordBatch], n_keys: int, most: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by their first ``n_keys`` columns; about ``most`` rows each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(i).to_numpy() for i in range(n_keys)]
        last = np.ones(len(keys[0]), bool)
        for k in keys:
            last &= k == k[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if (~last).any() else 0  # the last group may go on
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _sketch_matrix(column: pa.ChunkedArray) -> np.ndarray:
    arr = column.combine_chunks()
    arr = arr.chunk(0) if isinstance(arr, pa.ChunkedArray) else arr
    return arr.flatten().to_numpy().reshape(-1, COORDINATES)


def _compare_small(loose: float):
    """key, rid, sketch (sorted by key) -> node, root: stars of nodes that look alike in some bucket."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, 1):
            key, rid, sketch = table.column(0).to_numpy(), table.column(1).to_numpy(), _sketch_matrix(table.column(2))
            left, right = [], []
            for k in range(1, SMALL):
                near = np.flatnonzero(key[:-k] == key[k:])
                if not len(near):
                    break
                alike = (sketch[near] == sketch[near + k]).sum(1) >= loose * COORDINATES
                left.append(rid[near[alike]])
                right.append(rid[near[alike] + k])
            if left:
                node, root = spanning_stars(np.concatenate(left), np.concatenate(right))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], schema=schema)

    return run


def alike_edges(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b``: edges that join all nodes whose sets may be similar. ``nodes``: ``rid, sketch``, a written table."""
    value = lambda j: F.element_at("sketch", j + 1)
    starts = F.array(*[F.xxhash64(F.lit(r), F.element_at("sketch", r * COORDINATES // RUNS + 1)) for r in range(RUNS)])
    rows = nodes.select("rid", F.explode(starts).alias("key"))
    edges = []
    for depth in range(DEPTH + 1):
        sizes = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "path-sizes")
        together = rows.join(sizes, "key")
        small = together.where(F.col("n") <= SMALL).select("key", "rid").join(nodes, "rid")
        edges.append(materialize(
            small.select("key", "rid", "sketch")
            .repartition("key")
            .sortWithinPartitions("key")
            .mapInArrow(_compare_small(threshold - LOOSE), "a long, b long"),
            "path-edges",
        ))
        if not sizes.where(F.col("n") > SMALL).limit(1).count():
            break
        large = together.where(F.col("n") > SMALL).select("key", "rid")
        if depth == DEPTH:
            centres = materialize(large.groupBy("key").agg(F.min("rid").alias("a")), "path-centres")
            edges.append(materialize(large.join(centres, "key").select("a", F.col("rid").alias("b")).where("a <> b").distinct(), "path-edges"))
            break
        first = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(COORDINATES)).cast("int")
        second = F.pmod(F.xxhash64("key", F.lit(2)), F.lit(4 * COORDINATES)).cast("int")
        child = lambda j: F.xxhash64("key", j, value(j))
        paths = F.when(second < COORDINATES, F.array(child(first), child(second))).otherwise(F.array(child(first)))
        rows = materialize(
            large.join(nodes, "rid").select("rid", F.explode(F.array_distinct(paths)).alias("key")), "path-rows"
        )
    found = edges[0]
    for e in edges[1:]:
        found = found.union(e)
    return found


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> s1, s2, shingles."""
    schema = pa.schema([("s1", pa.int64()), ("s2", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    for batch in batches:
        for lo, hi, data, offsets in text_slices(batch.column(0)):
            rows, hashes = shingles(data, offsets)
            size = np.bincount(rows, minlength=hi - lo)
            full = size[size > 0]
            ends = np.concatenate([[0], np.cumsum(full)]).astype(np.int32)
            s1, s2 = _names(hashes, ends[:-1].astype(np.int64)) if len(full) else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(s1), pa.array(s2), pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))],
                schema=schema,
            )


def link_tile(sizes: np.ndarray, values: np.ndarray, owner: np.ndarray, cross: np.ndarray | None, threshold: float) -> np.ndarray:
    """Which pairs of a tile's sets are linked (a square of booleans, false on the diagonal).

    ``values``: shingles of all sets, ``owner``: the set of each; ``cross``: block of each set if
    only pairs of different blocks count.
    """
    n = len(sizes)
    names, column, seen = np.unique(values, return_inverse=True, return_counts=True)
    shared = seen[column] > 1
    column, owner = (np.cumsum(seen > 1) - 1)[column[shared]], owner[shared]
    common = np.zeros((n, n), np.float64)
    width = int((seen > 1).sum())
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    step = max(256, (4 << 20) // max(1, n))
    for at in range(0, width, step):
        lo, hi = np.searchsorted(column, [at, at + step])
        x = np.zeros((n, min(step, width - at)), np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        common += x @ x.T
    linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    np.fill_diagonal(linked, False)
    if cross is not None:
        linked &= cross[:, None] != cross[None, :]
    return linked


def _verify(threshold: float):
    """cluster, t1, t2, block, rid, weight, shingles (sorted by tile) -> rid, links, root."""
    schema = pa.schema([("rid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, 3, 2000):
            cluster, t1, t2, block, rid, weight = (table.column(i).to_numpy() for i in range(6))
            lists = table.column(6).combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            sizes = np.diff(lists.offsets.to_numpy())
            values, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
            new = np.ones(len(rid), bool)
            new[1:] = (cluster[1:] != cluster[:-1]) | (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1])
            bounds = np.append(np.flatnonzero(new), len(rid))
            links, root = np.zeros(len(rid), np.int64), rid.copy()
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo < 2:
                    continue
                owner = np.repeat(np.arange(hi - lo), sizes[lo:hi])
                cross = block[lo:hi] if t1[lo] != t2[lo] else None
                linked = link_tile(sizes[lo:hi].astype(np.float64), values[ends[lo] : ends[hi]], owner, cross, threshold)
                links[lo:hi] = linked @ weight[lo:hi]
                i, j = np.nonzero(np.triu(linked))
                if len(i):
                    place = {int(r): k for k, r in enumerate(rid[lo:hi])}
                    for node, to in zip(*spanning_stars(rid[lo + i], rid[lo + j])):
                        root[lo + place[int(node)]] = to
            some = (links > 0) | (root != rid)
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (rid, links, root)], schema=schema)

    return run


def _classes(docs: DataFrame, threshold: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The documents (``doc_id, text_hash, n, s1, s2``; n shingles, the set named by s1 and s2) and, for every set,
    ``root`` (its class), ``class_id``, ``n_links`` and ``class_size``; both written."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"))
    named = materialize(
        texts.select("text", "doc_id", F.xxhash64("text").alias("text_hash"))
        .mapInArrow(_sketch, f"doc_id {kind}, text_hash long, n int, s1 long, s2 long, sketch array<int>"), "join-sketches"
    )
    distinct = (
        named.where("n > 0")
        .groupBy("s1", "s2")
        .agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("weight"), F.first("sketch").alias("sketch"))
    )
    nodes = materialize(with_position(distinct, ["s1", "s2"], "rid"), "join-nodes")
    groups = materialize(components(alike_edges(nodes.select("rid", "sketch"), threshold)), "join-groups")

    inside = groups.select(F.col("node").alias("rid"), F.col("root").alias("cluster"))
    members = materialize(nodes.join(inside, "rid").select("rid", "cluster", "s1", "s2", "doc", "weight"), "join-members")
    wanted = members.select(F.col("doc").alias("_doc"))
    sets = (
        texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
        .select("text")
        .mapInArrow(_sets, "s1 long, s2 long, shingles array<long>")
        .dropDuplicates(["s1", "s2"])
        .join(members.drop("doc"), ["s1", "s2"])
    )
    counted = materialize(members.groupBy("cluster").agg(F.count(F.lit(1)).alias("g")), "join-counted")
    blocks = F.ceil(F.col("g") / TILE).cast("int")
    sets = materialize(
        sets.join(counted, "cluster").select(
            "cluster", "rid", "weight", "shingles", blocks.alias("blocks"),
            F.pmod(F.xxhash64("rid"), blocks).cast("int").alias("block"),
        ),
        "join-sets",
    )
    tiles = sets.select(
        "cluster", "block", "rid", "weight", "shingles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "cluster", F.least("block", "other").alias("t1"), F.greatest("block", "other").alias("t2"), "block", "rid", "weight", "shingles"
    )
    verified = materialize(
        tiles.repartition("cluster", "t1", "t2")
        .sortWithinPartitions("cluster", "t1", "t2", "rid")
        .mapInArrow(_verify(threshold), "rid long, links long, root long"),
        "join-verified",
    )
    links = verified.groupBy("rid").agg(F.sum("links").alias("links"))
    classes = components(verified.where("rid <> root").select(F.col("rid").alias("a"), F.col("root").alias("b")))
    placed = materialize(
        nodes.select("rid", "s1", "s2", "doc", "weight")
        .join(links, "rid", "left")
        .join(classes.select(F.col("node").alias("rid"), "root"), "rid", "left")
        .select(
            "s1", "s2", "doc", "weight", F.coalesce("root", "rid").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        ),
        "join-placed",
    )
    per_class = materialize(
        placed.groupBy("root").agg(F.min("doc").alias("class_id"), F.sum("weight").alias("class_size")), "join-classes"
    )
    return named, materialize(placed.join(per_class, "root").select("s1", "s2", "root", "class_id", "n_links", "class_size"), "join-final")


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, class_id, n_links, class_size`` for every document; links count copies of the linked texts too."""
    named, final = _classes(docs, threshold, id_col, text_col)
    known = named.where("n > 0").select("doc_id", "s1", "s2").join(final, ["s1", "s2"])
    alone = named.where("n = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.lit(1).cast("bigint").alias("class_size")
    )
    return known.select("doc_id", "class_id", "n_links", "class_size").unionByName(alone)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every class; all columns.

    The row of smallest id stays (null last; of equal ids, that of the smallest text hash; of rows equal in both, the
    smallest by all columns). Rows are told apart by id and text, so another text of the same id is not touched, and
    copies without an id are one class too. A text without words is in no class and stays.
    """
    named, final = _classes(docs, threshold, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    rows = named.where("n > 0").join(final.select("s1", "s2", "root"), ["s1", "s2"])
    rows = materialize(rows.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).withColumn("at", order), "join-rows")
    first = rows.groupBy("root").agg(F.min("at").alias("first"), F.sum("n").alias("size")).where("size > 1")
    marked = rows.join(first, "root").select("doc_id", "text_hash", (F.col("at") == F.col("first")).alias("stays"), "n")
    marked = materialize(marked.where("NOT stays OR n > 1"), "join-marked")
    id_name, hash_name = fresh("marked_id", docs.columns), fresh("marked_text", docs.columns)
    same = F.col(id_col).eqNullSafe(F.col(id_name)) & (F.xxhash64(text_col) == F.col(hash_name))
    some = lambda which: marked.where(which).select("doc_id", "text_hash").toDF(id_name, hash_name)
    left = docs.join(some("NOT stays"), same, "left_anti")
    if not marked.where("stays").limit(1).count():
        return left
    columns = [F.col(f"`{c}`") for c in docs.columns]
    group = [F.col(f"`{id_col}`").alias("id"), F.xxhash64(text_col).alias("text")]
    one = left.join(some("stays"), same, "left_semi").groupBy(*group).agg(F.min(F.struct(*columns)).alias("row")).select("row.*")
    return left.join(some("stays"), same, "left_anti").unionByName(one)
