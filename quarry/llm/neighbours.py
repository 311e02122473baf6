"""Approximate nearest neighbours by inner product over learned partitions.

Fit, on a bounded sample (``SAMPLE_ROWS`` rows and ``SAMPLE_CELLS`` numbers per vector length). One half of the sample gives a graph of each
vector's ``GRAPH_NEIGHBOURS`` best others. The graph is cut into ``2 ** i`` parts: bisections at the median of
the main direction, then passes that move a vector to the part that holds most of its neighbours as long as no part
leaves ``BALANCE`` of the even size. A softmax classifier learns the parts of a vector and its neighbours. The other half sets the number of probes: the
fewest most probable parts that hold ``target`` of the neighbours there.

Index and search, on all rows. The classifier puts every row into its most probable part, and
routes a query to its ``probes`` most probable ones. A part is cut into blocks of rows and its
queries into blocks of queries; a tile of both is multiplied and keeps each query's k best. No
task holds more than a tile, however uneven the parts are. Lists meet in two steps. Scores are
sums of products from the first component to the last, in double precision, so equal vectors
tie exactly. Vectors of another length are not compared. Where a length has few rows, there is one part and the
result is exact.

Nulls, ties, repeats: vectors that are null, zero or hold a null or non-finite component take no part; rows without an
id are candidates only; each row counts, and of rows that share an id each is its own query; ties go to the smaller id, null first; products too
large for a double come first, undefined ones (NaN) last. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.models import materialize

SAMPLE_ROWS, SAMPLE_CELLS = 8192, 1 << 24
ROWS_PER_PART, MOST_PARTS = 256, 64
GRAPH_NEIGHBOURS, BALANCE, PASSES = 10, 1.1, 6
EPOCHS, BATCH, RATE = 30, 256, 0.02
CALIBRATION_QUERIES = 512
TARGET = 0.95
TILE_ROWS = 1024
MERGE = 64


def graph(x: np.ndarray, k: int) -> np.ndarray:
    """For every row the ``k`` other rows of largest inner product."""
    found = []
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        found.append(np.argpartition(-s, k - 1, axis=1)[:, :k])
    return np.concatenate(found)


def bisections(x: np.ndarray, parts: int) -> np.ndarray:
    """Parts of equal size: each half is cut at the median of its main direction."""
    part = np.zeros(len(x), np.int64)
    cells = 1
    while cells < parts:
        for cell in range(cells):
            own = np.flatnonzero(part == cell)
            centred = x[own] - x[own].mean(0)
            direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            order = np.argsort(centred @ direction, kind="stable")
            part[own[order[len(own) // 2 :]]] = cell + cells
        cells *= 2
    return part


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """A part per row, so that few edges of the neighbour graph cross parts and no part is far from the even size."""
    part = bisections(x, parts)
    n, k = near.shape
    ends = np.concatenate([np.repeat(np.arange(n), k), near.ravel()])
    others = np.concatenate([near.ravel(), np.repeat(np.arange(n), k)])
    even = n / parts
    sizes = np.bincount(part, minlength=parts)
    for _ in range(PASSES):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (ends, part[others]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        for i in np.argsort(-gain, kind="stable")[: np.count_nonzero(gain > 0)]:
            if sizes[best[i]] < even * BALANCE and sizes[part[i]] > even / BALANCE:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
    return part


def classifier(x: np.ndarray, wanted: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and offsets of a softmax model of ``wanted`` (shares of parts per row), by Adam steps."""
    rng = np.random.default_rng(seed)
    scale = max(float(np.sqrt((x * x).sum(1).mean())), 1e-300)
    x = np.hstack([x / scale, np.ones((len(x), 1))])
    w = np.zeros((x.shape[1], wanted.shape[1]))
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    for epoch in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            z = x[rows] @ w
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            slope = x[rows].T @ (p - wanted[rows]) / len(rows)
            step += 1
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            w -= RATE * (1 - epoch / EPOCHS) * 10 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1] / scale, w[-1]


class Router:
    """A classifier for vectors of one length, and how many parts a query visits."""

    def __init__(self, weights: np.ndarray, offsets: np.ndarray, probes: int = 1) -> None:
        self.weights, self.offsets, self.probes = weights, offsets, probes

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts of every row, the most probable first."""
        return np.argsort(-(x @ self.weights + self.offsets), axis=1, kind="stable")


def fit(sample: np.ndarray, parts: int, k: int, target: float, seed: int = 1) -> Router:
    """A router for the vectors that ``sample`` stands for; with one part there is nothing to learn."""
    if parts < 2:
        return Router(np.zeros((sample.shape[1], 1)), np.zeros(1))
    sample = np.random.default_rng(seed).permutation(sample)
    train, rest = np.unique(sample[::2], axis=0), sample[1::2]  # copies would fill a neighbourhood
    if len(train) <= max(parts, GRAPH_NEIGHBOURS):
        return Router(np.zeros((sample.shape[1], 1)), np.zeros(1))
    near = graph(train, GRAPH_NEIGHBOURS)
    part = balanced_parts(train, near, parts)
    wanted = np.zeros((len(train), parts))
    np.add.at(wanted, (np.arange(len(train)), part), GRAPH_NEIGHBOURS)
    np.add.at(wanted, (np.repeat(np.arange(len(train)), GRAPH_NEIGHBOURS), part[near].ravel()), 1)
    router = Router(*classifier(train, wanted / wanted.sum(1, keepdims=True), seed))
    asked = rest[:CALIBRATION_QUERIES]
    s = asked @ rest.T
    s[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    found = np.argsort(-s, axis=1, kind="stable")[:, : min(k, len(rest) - 1)]
    order = router.ranked(asked)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(asked), 0), 1)
    visits = np.take_along_axis(place, router.ranked(rest)[:, 0][found], 1)  # the probe that finds each neighbour
    held = np.cumsum(np.bincount(visits.ravel(), minlength=parts)) / max(1, visits.size)
    router.probes = int(np.argmax(held >= target)) + 1
    return router


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _routed(routers: dict[int, Router], first_part: dict[int, int]):
    """Adds each row's ``part`` and, for queries, the ``probes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths):
                some = batch.take(pa.array(np.flatnonzero(lengths == length)))
                router, start = routers[int(length)], first_part[int(length)]
                order = router.ranked(_matrix(some.column("v"), int(length)))
                asks = some.column("q").to_numpy(zero_copy_only=False)
                probes = [list(map(int, row[: router.probes] + start)) if q else None for row, q in zip(order, asks)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(c) for c in ("row", "vec_id", "v")]
                    + [pa.array(order[:, 0] + start, pa.int32()), pa.array(probes, pa.list_(pa.int32()))],
                    ["row", "vec_id", "v", "part", "probes"],
                )

    return run


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``b`` beside them, summed from the first component on."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def tile_best(q_rows: np.ndarray, q: np.ndarray, rows: np.ndarray, known: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int):
    """``query place, candidate place, score`` of each query's ``k`` best, its own row left out."""
    with np.errstate(all="ignore"):
        s = q @ c.T
        s[np.isnan(s)] = -np.inf
        s[q_rows[:, None] == rows[None, :]] = -np.inf
        room = 8 * q.shape[1] * np.finfo(float).eps * np.abs(q).sum(1).max(initial=0) * np.abs(c).max(initial=0)
        if len(c) > k:
            keep = ~(s < np.partition(s, len(c) - k, axis=1)[:, len(c) - k][:, None] - room)
        else:
            keep = np.ones(s.shape, bool)
        keep &= q_rows[:, None] != rows[None, :]
        asks, found = np.nonzero(keep)
        score = products(q[asks], c[found])
    order = np.lexsort((ids[found], known[found], -score, asks))
    asks, found, score = asks[order], found[order], score[order]
    place = np.arange(len(asks)) - np.searchsorted(asks, asks)
    return asks[place < k], found[place < k], score[place < k]


def _tile(k: int):
    names = ["query", "query_id", "part", "block", "vec_id", "score"]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        if not len(left) or not len(right):
            return pa.table({n: pa.array([], pa.float64() if n == "score" else pa.int64()) for n in names})
        whole = lambda table, c: table.column(c).combine_chunks()
        flat = lambda col: col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
        q, c = flat(whole(left, "v")), flat(whole(right, "v"))
        length = len(c[0].values)
        ids = flat(whole(right, "vec_id"))
        asks, found, score = tile_best(
            left.column("row").to_numpy(), _matrix(q, length), right.column("row").to_numpy(),
            ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), _matrix(c, length), k,
        )
        some = left.take(pa.array(asks))
        return pa.table([
            some.column("row"), some.column("vec_id"), pa.array(np.full(len(asks), key[0].as_py())),
            pa.array(np.full(len(asks), key[1].as_py())), ids.take(pa.array(found)), pa.array(score),
        ], names=names)

    return run


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v, length`` of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return (
        df.select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("v"))
        .where(F.col("v").isNotNull() & finite & F.exists("v", lambda c: c != 0))
        .withColumn("length", F.size("v"))
    )


def _routers(table: DataFrame, k: int, target: float) -> dict[int, Router]:
    """A router for every vector length of the table."""
    routers = {}
    for length, n in table.groupBy("length").count().collect():  # one row per vector length
        parts = 1
        while parts < MOST_PARTS and parts * 2 * ROWS_PER_PART <= n:
            parts *= 2
        if parts == 1:
            routers[length] = fit(np.zeros((0, length)), 1, k, target)
            continue
        rows = max(1024, min(SAMPLE_ROWS, SAMPLE_CELLS // length))
        sample = table.where(F.col("length") == length).orderBy(F.xxhash64("row", F.lit(5))).limit(rows).select("v").toArrow()
        routers[length] = fit(_matrix(sample.column("v").combine_chunks(), length), parts, k, target)
    return routers


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, target: float = TARGET, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for every row where ``is_query`` (on ``vec_id``)."""
    numbered = usable(vectors, id_col, vector_col).withColumns(
        {"q": F.coalesce(is_query, F.lit(False)), "row": F.monotonically_increasing_id()}
    )
    table = materialize(numbered, "neighbour-rows")
    routers = _routers(table, k, target)
    sizes = [len(r.offsets) for r in routers.values()]
    first_part = dict(zip(routers, np.concatenate([[0], np.cumsum(sizes)]).tolist()))
    routed = materialize(
        table.mapInArrow(_routed(routers, first_part), "row long, vec_id long, v array<double>, part int, probes array<int>"),
        "neighbour-parts",
    )
    asked = routed.where(F.col("probes").isNotNull()).select("row", "vec_id", "v", F.explode("probes").alias("part"))
    cuts = lambda df, name: df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias(name))
    parts = F.broadcast(materialize(cuts(routed, "blocks").join(cuts(asked, "q_blocks"), "part"), "neighbour-cuts"))  # MOST_PARTS rows a length
    place = lambda count, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    own = [F.col(c).alias(c) for c in ("part", "row", "vec_id", "v")]  # both sides of the tiles come from one table
    candidates = routed.join(parts, "part").select(*own, place("blocks", 1).alias("block"), every("q_blocks").alias("q_block"))
    queries = asked.join(parts, "part").select(*own, every("blocks").alias("block"), place("q_blocks", 2).alias("q_block"))
    keys = ["part", "block", "q_block"]
    best = (
        queries.groupBy(*keys).cogroup(candidates.groupBy(*keys))
        .applyInArrow(_tile(k), "query long, query_id long, part long, block long, vec_id long, score double")
        .withColumn("some", F.pmod(F.xxhash64("part", "block"), F.lit(MERGE)))
    )
    for group in (["query", "some"], ["query"]):
        order = Window.partitionBy(*group).orderBy(F.isnan("score"), F.desc("score"), F.asc_nulls_first("vec_id"))
        best = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
