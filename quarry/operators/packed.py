"""Sparse vectors as two binary columns, for operators that pass over the same rows many times.

Spark copies an array column to Python number by number, a binary one in a piece. A row's ``slots`` are its
``indices`` as 32-bit integers, its ``numbers`` its ``values`` as doubles; a null list is an empty one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

TABLE_SLOTS = 1 << 22


def _binary(lengths: np.ndarray, numbers: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths * numbers.itemsize)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(numbers))])


def pack(points: DataFrame, keep: list[str]) -> DataFrame:
    """``keep..., slots, numbers`` of rows with ``indices`` and ``values``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            indices, values = batch.column("indices"), batch.column("values")
            packed = [
                _binary(np.diff(indices.offsets.to_numpy()), indices.flatten().to_numpy(zero_copy_only=False).astype(np.int32)),
                _binary(np.diff(values.offsets.to_numpy()), values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *packed], [*keep, "slots", "numbers"])

    fields = [*[points.schema[c] for c in keep], T.StructField("slots", T.BinaryType()), T.StructField("numbers", T.BinaryType())]
    return points.select(*keep, "indices", "values").mapInArrow(run, T.StructType(fields))


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    size = np.dtype(kind).itemsize
    return np.diff(ends) // size, np.frombuffer(data, kind, (ends[-1] - ends[0]) // size, ends[0]) if data is not None else np.zeros(0, kind)


def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of every entry, rows ascending."""
    if not batch.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0)
    lengths, slot = _flat(batch.column("slots"), np.int32)
    return np.repeat(np.arange(batch.num_rows), lengths), slot, _flat(batch.column("numbers"), np.float64)[1]


def places(slots: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every ``slot`` in the ascending ``slots`` (any, if absent), and whether it is there."""
    if not len(slots):
        return np.zeros(len(slot), np.int64), np.zeros(len(slot), bool)
    top = int(slots[-1])
    if 0 <= int(slots[0]) and top < TABLE_SLOTS:
        table = np.full(top + 2, -1)
        table[slots] = np.arange(len(slots))
        at = table[np.where((slot < 0) | (slot > top), top + 1, slot)]
        return np.maximum(at, 0), at >= 0
    at = np.minimum(np.searchsorted(slots, slot), len(slots) - 1)
    return at, slots[at] == slot
