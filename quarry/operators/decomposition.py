"""Principal components of wide sparse vectors by block power iteration.

Spark's ``PCA`` builds the covariance, width squared numbers on the driver. Here the driver holds a block of
``k`` (and a few more) vectors on the slots that occur. One step multiplies the block by the covariance: a task computes its rows'
products with the block and hands back sums per slot, Spark adds these up, and the driver
orthonormalises the result. A last step solves the small problem inside the block (Rayleigh-Ritz), which
gives components and variances; with as many vectors as slots it is exact after one step.

Rows are a table with ``indices`` and ``values`` (``features.sparse_vector_parts``); it is read
three times, so it should be written; the steps read a packed copy. Signs: the weight of largest size is positive (of equals, that of the smallest slot).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.models import materialize
from quarry.operators.packed import entries, pack, places

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

MAX_CELLS = 1 << 25
EXTRA = 8


@dataclass
class Components:
    """``weights``: slots x k; ``slots`` ascend; ``variances`` of the projections, largest first."""

    slots: np.ndarray
    weights: np.ndarray
    variances: np.ndarray


def _entries(batch: pa.RecordBatch, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place of the slot and value of every entry whose slot is in ``slots``."""
    row, slot, value = entries(batch)
    at, held = places(slots, slot)
    return (row, at, value) if held.all() else (row[held], at[held], value[held])


def _projected(row: np.ndarray, at: np.ndarray, value: np.ndarray, n: int, block: np.ndarray) -> np.ndarray:
    """Rows x block products; entries ascend by row."""
    out = np.zeros((n, block.shape[1]))
    for j in range(block.shape[1]):
        out[:, j] = np.bincount(row, weights=value * block[at, j], minlength=n)
    return out


def _products(slots: np.ndarray, block: np.ndarray):
    """Sums per slot of value times the row's products with the block, over all rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(block.shape)
        for batch in batches:
            row, at, value = _entries(batch, slots)
            products = _projected(row, at, value, batch.num_rows, block)
            for j in range(block.shape[1]):
                total[:, j] += np.bincount(at, weights=value * products[row, j], minlength=len(slots))
        place, column = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(column), pa.array(total[place, column])], ["place", "column", "total"])

    return run


def principal_components(points: DataFrame, k: int, steps: int = 20, seed: int = 1) -> Components:
    """The ``k`` components of largest variance; raises if ``k`` exceeds the number of slots that occur or the block the bound."""
    entry = points.select(F.explode(F.arrays_zip("indices", "values")).alias("e")).select("e.*")
    sums = entry.groupBy("indices").agg(F.sum("values").alias("s")).orderBy("indices").collect()  # a row per slot, at most the vector width
    n = points.count()
    slots, mean = np.array([r.indices for r in sums], np.int64), np.array([r.s for r in sums]) / max(1, n)
    if k > len(slots) or n < 2:
        raise ValueError(f"{k} components of {len(slots)} slots and {n} rows")
    width = min(len(slots), k + EXTRA)
    if width * len(slots) > MAX_CELLS:
        raise ValueError(f"{width} vectors of {len(slots)} slots: more than {MAX_CELLS} numbers")

    def by_covariance(block: np.ndarray) -> np.ndarray:
        parts = packed.mapInArrow(_products(slots, block), "place long, column long, total double")
        whole = parts.groupBy("place", "column").agg(F.sum("total").alias("total")).toArrow()
        out = np.zeros(block.shape)
        out[whole.column("place").to_numpy(), whole.column("column").to_numpy()] = whole.column("total").to_numpy()
        return (out - n * np.outer(mean, mean @ block)) / (n - 1)

    packed = materialize(pack(points, []), "packed")
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(slots), width)))[0]
    for _ in range(steps if width < len(slots) else 0):
        block = np.linalg.qr(by_covariance(block))[0]
    inner = block.T @ by_covariance(block)
    variances, turn = np.linalg.eigh((inner + inner.T) / 2)
    best = np.argsort(-variances, kind="stable")[:k]
    weights = block @ turn[:, best]
    lead = weights[np.abs(weights).argmax(0), np.arange(k)]
    return Components(slots, weights * np.where(lead < 0, -1.0, 1.0), variances[best])


def project(points: DataFrame, found: Components, keep: list[str], out: str = "components") -> DataFrame:
    """``keep..., out``: the rows' products with the components (not centred, as ``PCA`` does)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            products = _projected(*_entries(batch, found.slots), batch.num_rows, found.weights)
            ends = np.arange(0, products.size + 1, products.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.ListArray.from_arrays(ends, pa.array(products.ravel()))], [*keep, out])

    fields = [*[points.schema[c] for c in keep], T.StructField(out, T.ArrayType(T.DoubleType()))]
    return pack(points, keep).mapInArrow(run, T.StructType(fields))
