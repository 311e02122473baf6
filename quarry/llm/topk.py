"""Exact top-k inner products: tiles of query block x vector block, merged as a tree.

Vectors become whole numbers, ``floor(scale * x)``, so scores are exact. Query rows and all
rows are hashed to blocks of bounded size; a tile holds one query block and one vector
block, multiplies them and keeps each query's best k. The lists then meet ``FAN`` tiles at a
time until one list per query is left, so no task ever merges all of them.

A row takes part if its id is not null and its vector neither null nor holding a null or
non-finite component. Each row counts: rows that share an id are candidates of each other, and
each is its own query. Only vectors of the same length are compared. Ties go to the smaller id. Scores beyond a
64-bit integer are held at its ends. No queries or no vectors give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.models import materialize

QUERY_BLOCK = 1024
VECTOR_BLOCK = 1024
FAN = 32
_EXACT = float(1 << 53)


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vec_id, v`` of the rows that take part, components ``floor(scale * x)`` as doubles."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(
        F.col("x"), lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))
    )
    return (
        df.select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite)
        .select("vec_id", F.transform("x", lambda c: _floor(c, scale)).alias("v"))
    )


def _floor(c: Column, scale: int) -> Column:
    """floor as a double: ``F.floor`` would pass through bigint, which large components overflow."""
    y = c * F.lit(float(scale))
    return F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``q`` and ``c`` (whole-valued doubles)."""
    if not q.shape[1]:
        return np.zeros((len(q), len(c)), np.int64)
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if most < _EXACT:
        return (q @ c.T).astype(np.int64)
    lows, highs = -(1 << 63) + 1, (1 << 63) - 1
    whole = [[int(x) for x in row] for row in c]
    return np.array(
        [[min(max(sum(a * b for a, b in zip(x, y)), lows), highs) for y in whole] for x in ([int(v) for v in r] for r in q)],
        np.int64,
    ).reshape(len(q), len(c))


def best_of_tile(query_rows: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's ``k`` best of this tile, its own row left out."""
    order = np.argsort(ids, kind="stable")  # then a stable sort by score leaves ties by id
    rows, ids, c = rows[order], ids[order], c[order]
    found = []
    step = max(1, (1 << 21) // max(1, len(ids)))
    for at in range(0, len(q), step):
        s = scores(q[at : at + step], c)
        for row, query in zip(s, query_rows[at : at + step]):
            keep = np.flatnonzero(rows != query)
            own = row[keep]
            if len(own) > k:
                floor = np.partition(own, len(own) - k)[len(own) - k]
                above = own >= floor
                keep, own = keep[above], own[above]
            pick = np.argsort(-own, kind="stable")[:k]
            found.append(pd.DataFrame({"query": query, "vec_id": ids[keep[pick]], "score": own[pick]}))
    return pd.concat(found, ignore_index=True) if found else pd.DataFrame({"query": [], "vec_id": [], "score": []})


def _tile(k: int):
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for width, some in left.groupby(left["v"].map(len)) if len(left) and len(right) else ():
            same = right[right["w"].map(len) == width]
            if len(same):
                parts.append(best_of_tile(
                    some["row"].to_numpy(), np.array(some["v"].tolist(), float).reshape(len(some), width),
                    same["own"].to_numpy(), same["id"].to_numpy(), np.array(same["w"].tolist(), float).reshape(len(same), width), k,
                ))
        out = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"query": [], "vec_id": [], "score": []})
        names = dict(zip(left["row"], left["vec_id"]))
        out["query_id"] = out["query"].map(names)
        out["block"] = int(key[1])
        return out[["query", "query_id", "vec_id", "score", "block"]].astype("int64")

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for every row where ``is_query`` (on ``vec_id``)."""
    whole = whole_vectors(vectors, id_col, vector_col, scale).withColumn("q", is_query)
    table = materialize(whole.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    n, m = table.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1))).first()
    n_blocks, q_blocks = max(1, -(-n // vector_block)), max(1, -(-m // query_block))
    block = lambda count, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(count)).cast("int")
    rows = table.select(
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_tile"),
        block(n_blocks, 1).alias("v_tile"),
        F.col("row").alias("own"),
        F.col("vec_id").alias("id"),
        F.col("v").alias("w"),
    )
    queries = table.where("q").select(
        block(q_blocks, 2).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("vb"), "row", "vec_id", "v"
    )
    best = (
        queries.groupBy("qb", "vb")
        .cogroup(rows.groupBy("q_tile", "v_tile"))
        .applyInPandas(_tile(k), "query long, query_id long, vec_id long, score long, block long")
    )
    first = True
    while first or n_blocks > 1:
        first = False
        n_blocks = -(-n_blocks // FAN)
        best = best.withColumn("block", F.floor(F.col("block") / FAN))
        order = Window.partitionBy("query", "block").orderBy(F.desc("score"), "vec_id")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
