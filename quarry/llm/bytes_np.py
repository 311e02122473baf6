"""Vectorised work on the bytes of many texts at once (numpy inside Arrow batches)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII digits and letters, and every byte of other characters.
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, end row, bytes, offsets`` of runs of rows of about ``most`` bytes (a longer text stands alone).

    Nulls are empty texts. ``offsets`` has one more entry than rows and starts at 0.
    """
    arr = pc.fill_null(column, "").cast(pa.large_binary()) if column.null_count else column.cast(pa.large_binary())
    n = len(arr)
    if not n:
        return
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + n + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Spans:
    """Words of a slice: start, end (byte places) and row of each, and a 64-bit hash of its bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> None:
        """``inside``: for each of 256 bytes, whether it is part of a word."""
        is_in = inside[data]
        before = np.zeros(len(data), bool)
        before[1:] = is_in[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = is_in[1:]
        if len(data):
            before[offsets[:-1][offsets[:-1] < len(data)]] = False
            after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.start = np.flatnonzero(is_in & ~before)
        self.end = np.flatnonzero(is_in & ~after) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=sums[1:])
        inverse = powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), len(data) + 1)
        self.hash = mix64((sums[self.end] - sums[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))

    def grams(self, n: int, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of every run of ``n`` words within a row."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        same = self.row[:m] == self.row[n - 1 :]
        h = np.zeros(m, np.uint64)
        for i in range(n):
            h = mix64(h + self.hash[i : i + m] * np.uint64(2 * i + 1))
        return self.row[:m][same], h[same]
