"""k-means on sparse vectors: start centres by a farthest-first rule, then Lloyd steps.

Points are rows with a key and a vector's ``indices`` and ``values``
(``features.sparse_vector_parts``); the steps read a written table of them in packed form (``packed``). The first centre is the point of largest norm, each further
one the point farthest from the centres so far; ties go to the smaller key. A step puts every point to its
nearest centre (the first of equals) and moves the centres to the means of their points; a centre that
loses all points is dropped. Steps end when no centre moves, or after ``max_steps``.

A task works on Arrow batches with numpy and hands back sums per centre and slot, which Spark adds up; the driver holds
the centres, ``k`` times the vector width at most.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.models import materialize
from quarry.operators.packed import entries, pack, places

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module


class Centres:
    """Centres on the slots that any of them uses (ascending); numbers name them over all steps."""

    def __init__(self, numbers: list[int], rows: list[dict[int, float]]) -> None:
        self.numbers = np.array(numbers, np.int64)
        self.slots = np.array(sorted({s for r in rows for s in r}), np.int64)
        self.matrix = np.zeros((len(rows), len(self.slots)))
        for i, row in enumerate(rows):
            at = np.searchsorted(self.slots, np.fromiter(row, np.int64, len(row)))
            self.matrix[i, at] = np.fromiter(row.values(), float, len(row))

    def distances(self, row: np.ndarray, slot: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Squared distances, points x centres, of points given as entries (``row`` ascends)."""
        inner = np.zeros((n, len(self.matrix)))
        if len(self.slots):
            at, held = places(self.slots, slot)
            if not held.all():
                at, row_held, value_held = at[held], row[held], value[held]
            else:
                row_held, value_held = row, value
            for c in range(len(self.matrix)):
                inner[:, c] = np.bincount(row_held, weights=value_held * self.matrix[c, at], minlength=n)
        norm = np.bincount(row, weights=value * value, minlength=n)
        return norm[:, None] - 2 * inner + (self.matrix**2).sum(1)[None, :]


def _sums(centres: Centres):
    """Per task the sums of the points of each centre by slot, and their number as slot -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centres.matrix)
        known, total, count = np.zeros(0, np.int64), np.zeros((k, 0)), np.zeros(k)
        for batch in batches:
            row, slot, value = entries(batch)
            near = centres.distances(row, slot, value, batch.num_rows).argmin(1)
            at, held = places(known, slot)
            if not held.all():
                wider = np.union1d(known, slot[~held]).astype(np.int64)
                grown = np.zeros((k, len(wider)))
                grown[:, np.searchsorted(wider, known)] = total
                known, total = wider, grown
                at, _ = places(known, slot)
            total += np.bincount(near[row] * len(known) + at, weights=value, minlength=total.size).reshape(total.shape)
            count += np.bincount(near, minlength=k)
        own = np.flatnonzero(count)
        numbers, slots = np.repeat(centres.numbers[own], len(known) + 1), np.tile(np.append(known, -1), len(own))
        totals = np.column_stack([total[own], count[own]]).ravel()
        kept = totals != 0
        yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (numbers, slots, totals)], ["cluster", "slot", "total"])

    return run


def _assigned(centres: Centres, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = centres.distances(*entries(batch), batch.num_rows).argmin(1)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(centres.numbers[near].astype(np.int32))], [*keep, "prediction"])

    return run


def _farthest(centres: Centres, key: str):
    """The points of each batch that are farthest from their centre (all of equals), as Spark orders numbers: NaN is largest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, slot, value = entries(batch)
            d = centres.distances(row, slot, value, batch.num_rows).min(1)
            best = np.isnan(d) if np.isnan(d).any() else d == d.max()
            held = best[row]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows)[best])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[held])) for x in (slot, value)]
            yield pa.RecordBatch.from_arrays([batch.column(key).filter(pa.array(best)), *lists, pa.array(d[best])], [key, "indices", "values", "distance"])

    return run


def _as_row(point) -> dict[int, float]:
    return dict(zip(point.indices, point["values"]))


def farthest_first(points: DataFrame, k: int, key: str) -> Centres:
    """The ``k`` start centres (fewer if there are fewer different points)."""
    lists = [T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([points.schema[key], *lists, T.StructField("distance", T.DoubleType())])
    rows: list[dict[int, float]] = []
    ahead = Centres([0], [{}])  # distances from 0 are norms
    for _ in range(k):
        far = points.select(key, "slots", "numbers").mapInArrow(_farthest(ahead, key), schema)
        best = far.orderBy(F.desc("distance"), key, "indices", "values").first()
        if best is None or rows and best.distance <= 0:
            break
        rows.append(_as_row(best))
        ahead = Centres(list(range(len(rows))), rows)
    return ahead


def lloyd(points: DataFrame, start: Centres, max_steps: int = 20) -> Centres:
    centres = start
    for _ in range(max_steps):
        sums = points.select("slots", "numbers").mapInArrow(_sums(centres), "cluster long, slot long, total double")
        rows: dict[int, dict[int, float]] = {}
        for cluster, slot, total in sums.groupBy("cluster", "slot").agg(F.sum("total")).collect():  # k x width at most
            rows.setdefault(cluster, {})[slot] = total
        counts = {c: r.pop(-1) for c, r in rows.items()}
        numbers = sorted(rows)
        moved = Centres(numbers, [{s: x / counts[c] for s, x in rows[c].items()} for c in numbers])
        same = len(moved.matrix) == len(centres.matrix) and len(moved.slots) == len(centres.slots) and np.array_equal(moved.slots, centres.slots)
        if same and np.allclose(moved.matrix, centres.matrix, rtol=1e-12, atol=1e-12):
            break
        centres = moved
    return centres


def kmeans(points: DataFrame, k: int, key: str, keep: list[str] | None = None, max_steps: int = 20) -> DataFrame:
    """``key, keep..., prediction``: the number of every point's centre, in the order in which the start centres were found.

    The points are written once in packed form, which every step reads.
    """
    kept = list(dict.fromkeys([key, *(keep or [])]))
    packed = materialize(pack(points, kept), "points")
    centres = lloyd(packed, farthest_first(packed, k, key), max_steps)
    fields = [*[points.schema[c] for c in kept], T.StructField("prediction", T.IntegerType())]
    return packed.mapInArrow(_assigned(centres, kept), T.StructType(fields))
