"""Benchmark decontamination by q-gram lemma filtering.

A document leaks an item if some part of it is within ``edits`` edits (one in ten characters)
of some ``WINDOW`` characters of the item, wherever they start, or of the whole item if that
is shorter. Windows that start every ``STRIDE`` are looked for first and are the ones that the
report counts; a row and item without any of them are searched at every other start at which
the filter below leaves a chance. Letters A-Z are folded
and white space counts as blanks.

Filter: by the q-gram lemma such a part shares at least ``length + 1 - q * (edits + 1)``
q-grams with the window, all within a band of ``edits + 1`` diagonals (place in the document
minus place in the item). Shared q-grams are counted per window and band of ``BAND``
diagonals; bands overlap by ``edits``, so every such set lies whole in one band. Regions that
reach the bound are verified by a banded alignment with free ends in the document. Places are
character offsets of whole texts.

The items are read in blocks of at most ``BLOCK_CHARS`` characters (a longer single item is a
block); a block's q-gram index is broadcast and the documents are scanned once for it, so a
benchmark of any size is covered and no document is shuffled.

Items of fewer than ``MIN_ITEM`` characters, which edits would let chance find, are leaked by an exact occurrence that
neither starts nor ends inside a word; they count as one window.

Nulls and ties: null and empty texts leak nothing; items without an id are searched for as well and reported with a null
id; items of a null text or without a letter or digit hold nothing to find; equal items are
reported each. Repeated rows are scanned each by itself. No items or no documents: no leaks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bytes_np import IS_SPACE, LOWER, mix64, text_slices

Q, WINDOW, STRIDE, MIN_ITEM, BAND = 8, 80, 40, 24, 16
EDIT_SHARE = 0.1
CORE_STRIDE = 20
CORE = WINDOW - CORE_STRIDE + 1
BLOCK_CHARS = 4_000_000
TABLE_BITS = 22
_STEP = np.uint64(0x100000001B3)
_FOLD = LOWER.copy()
_FOLD[IS_SPACE] = 32
LEAKS = "item_id long, start int, end int, windows int, item_windows int, edits int"


class Index(NamedTuple):
    ids: list[int | None]  # item id by item number
    chars: np.ndarray  # all items' characters
    first: np.ndarray  # where each item starts in chars
    codes: np.ndarray  # sorted distinct q-gram codes
    code_at: np.ndarray  # of each code, where its places start in `item` and `place`
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray  # which hash slots any code has
    short: list[tuple[int | None, str]]  # id and folded text of the items that are searched for exactly


def _chars(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of a slice as numbers, and character offsets."""
    chars = np.frombuffer(_FOLD[data].tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=starts[1:])
    return chars, starts[offsets]


def _codes(chars: np.ndarray) -> np.ndarray:
    n = len(chars) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = chars.astype(np.uint64)
    code = wide[:n].copy()
    for j in range(1, Q):
        code *= _STEP
        code += wide[j : n + j]
    return mix64(code)


def _windows(length: int) -> list[tuple[int, int]]:
    """Start and length of an item's windows; the last one ends with the item."""
    if length <= WINDOW:
        return [(0, length)]
    starts = list(range(0, length - WINDOW, STRIDE)) + [length - WINDOW]
    return [(s, WINDOW) for s in starts]


def edit_budget(length: int) -> int:
    """Edits allowed in a window: a share of its length, as far as the lemma still asks for one q-gram."""
    return max(0, min(int(length * EDIT_SHARE), length // Q - 1))


def _folded(data: np.ndarray) -> str:
    return _FOLD[data].tobytes().decode("utf-8", "surrogatepass")


def build_index(items: list[tuple[int | None, str]]) -> Index:
    none = np.zeros(0, np.int64)
    ids, parts, codes, item, place, short = [], [none.astype(np.uint32)], [none.astype(np.uint64)], [none], [none], []
    for item_id, text in items:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if len(text) < MIN_ITEM:
            short.append((item_id, _folded(data)))
            continue
        chars, _ = _chars(data, np.array([0, len(data)]))
        own = _codes(chars)
        codes.append(own)
        item.append(np.full(len(own), len(ids), np.int64))
        place.append(np.arange(len(own), dtype=np.int64))
        ids.append(item_id)
        parts.append(chars)
    first = np.cumsum([len(p) for p in parts]).astype(np.int64)
    all_codes, item, place = np.concatenate(codes), np.concatenate(item), np.concatenate(place)
    order = np.argsort(all_codes, kind="stable")
    distinct, at = np.unique(all_codes[order], return_index=True)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[distinct >> np.uint64(64 - TABLE_BITS)] = True
    return Index(
        ids, np.concatenate(parts), first, distinct, np.append(at, len(order)), item[order], place[order], table, short
    )


def _automaton(short: list[tuple[int | None, str]]) -> ahocorasick.Automaton | None:
    """Finds the texts of ``short``; an entry is the text and the ids of its items."""
    by_text: dict[str, list[int | None]] = {}
    for item_id, text in short:
        by_text.setdefault(text, []).append(item_id)
    if not by_text:
        return None
    found = ahocorasick.Automaton()
    for text, ids in by_text.items():
        found.add_word(text, (text, ids))
    found.make_automaton()
    return found


def find_exact(automaton: ahocorasick.Automaton | None, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int | None, int, int]]:
    """``row, item id, start, end`` of the short items in a slice; a row and item with several occurrences spans them."""
    for row in range(len(offsets) - 1 if automaton else 0):
        text = _folded(data[offsets[row] : offsets[row + 1]])
        seen: dict[str, list] = {}
        for last, (item, ids) in automaton.iter(text):
            start, end = last + 1 - len(item), last + 1
            inside = start and text[start - 1].isalnum() and item[0].isalnum() or end < len(text) and text[end].isalnum() and item[-1].isalnum()
            if not inside:
                span = seen.setdefault(item, [start, end, ids])
                span[1] = end
        for start, end, ids in seen.values():
            for item_id in ids:
                yield row, item_id, start, end


def _hits(index: Index, chars: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text row, place in the slice, item and place in the item of every shared q-gram."""
    codes = _codes(chars)
    at = np.flatnonzero(index.table[codes >> np.uint64(64 - TABLE_BITS)])
    slot = np.searchsorted(index.codes, codes[at])
    slot[slot == len(index.codes)] = 0
    same = index.codes[slot] == codes[at]
    at, slot = at[same], slot[same]
    row = np.searchsorted(offsets, at, "right") - 1
    inside = at + Q <= offsets[row + 1]
    at, slot, row = at[inside], slot[inside], row[inside]
    n = index.code_at[slot + 1] - index.code_at[slot]
    which = np.repeat(index.code_at[slot] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else slot
    return np.repeat(row, n), np.repeat(at, n), index.item[which], index.place[which]


def _dense(index: Index, row: np.ndarray, at: np.ndarray, item: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which hits can count: a band of their row and item has as many as a window needs, or the item is shorter.

    Bands are counted in hashed slots: two bands in a slot let hits stay, never go.
    """
    most = edit_budget(WINDOW)
    pair = (row * (len(index.first) - 1) + item).astype(np.uint64) * _STEP
    shift = at - place
    bits = max(10, len(row).bit_length() + 2)
    slots = [(mix64(pair + (shift // BAND - step).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64) for step in (0, 1)]
    second = shift % BAND < most  # the diagonal is also in the band before
    n = np.bincount(slots[0], minlength=1 << bits) + np.bincount(slots[1][second], minlength=1 << bits)
    enough = n >= WINDOW + 1 - Q * (most + 1)
    return enough[slots[0]] | (second & enough[slots[1]]) | ((index.first[1:] - index.first[:-1])[item] <= WINDOW)


def _between(
    index: Index, chars: np.ndarray, offsets: np.ndarray, hits: tuple[np.ndarray, ...], done: set[tuple[int, int]]
) -> list[tuple[int, ...]]:
    """Leaks by windows at any place of an item, for rows and items not in ``done``: ``row, item, start, end, edits``."""
    row, at, item, place = hits
    lengths = index.first[1:] - index.first[:-1]
    pair = row * len(lengths) + item
    known = np.array([r * len(lengths) + it for r, it in done], np.int64)
    left = (lengths[item] > WINDOW) & ~np.isin(pair, known)
    pair, at, place = pair[left], at[left], place[left]
    if not len(pair):
        return []
    most, shift = edit_budget(WINDOW), at - place
    need = WINDOW + 1 - Q * (most + 1)
    low_band = int(shift.min()) // BAND - 1
    n_bands = int(shift.max()) // BAND - low_band + 1
    keys, picks = [], []
    for step in (0, 1):  # the bands that hold the diagonal
        band = shift // BAND - step
        pick = np.flatnonzero(shift - (band + 1) * BAND < most) if step else np.arange(len(shift))
        keys.append(pair[pick] * n_bands + (band[pick] - low_band))
        picks.append(pick)
    key, pick = np.concatenate(keys), np.concatenate(picks)
    order = np.lexsort((place[pick], key))
    key, places = key[order], place[pick][order]
    # `need` hits of one key within a window's q-grams
    ahead = np.arange(len(key)) + need - 1
    inside = ahead < len(key)
    ahead = np.where(inside, ahead, 0)
    inside &= (key[ahead] == key) & (places[ahead] - places <= WINDOW - Q)
    i = np.flatnonzero(inside)
    key, low, high = key[i], places[ahead[i]] + Q - WINDOW, places[i]
    low, high = np.maximum(0, low), np.minimum(high, lengths[key // n_bands % len(lengths)] - WINDOW)

    def spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Distinct keys and starts, from first to last for each key."""
        n = np.maximum(0, last - first + 1)
        start = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.unique(np.stack([np.repeat(key, n), start]), axis=1)

    def fits(some: np.ndarray, width: int) -> Iterator[tuple[int, int, int, int, int]]:
        for lo in range(0, some.shape[1], 4096):
            k, from_ = some[:, lo : lo + 4096]
            r_item, band = np.divmod(k, n_bands)
            r, it = np.divmod(r_item, len(lengths))
            for j, stop, edits in _align(index, chars, offsets, r, it, from_, band + low_band, width, most):
                yield lo + j, int(r[j]), int(it[j]), stop, edits

    # every window holds CORE characters that start at a multiple of CORE_STRIDE, with no more edits
    cores = spread(-(-low // CORE_STRIDE), -(-high // CORE_STRIDE))
    hold = [j for j, *_ in fits(cores * [[1], [CORE_STRIDE]], CORE)]
    if not hold:
        return []
    key, core = cores[:, hold]
    low, high = (core - 1) * CORE_STRIDE + 1, core * CORE_STRIDE
    windows = spread(np.maximum(0, low), np.minimum(high, lengths[key // n_bands % len(lengths)] - WINDOW))
    return [(r, it, max(0, stop - WINDOW), stop, edits) for _, r, it, stop, edits in fits(windows, WINDOW)]


def _align(index, chars, offsets, row, item, from_, band, width: int, most: int) -> Iterator[tuple[int, int, int]]:
    """Windows at ``from_`` of the items that are found in their rows with ``most`` edits: number, end in the row, edits."""
    pattern = index.chars[(index.first[item] + from_)[:, None] + np.arange(width)]
    left = from_ + band * BAND - most
    where = left[:, None] + np.arange(width + BAND + 3 * most)
    valid = (where >= offsets[row][:, None]) & (where < offsets[row + 1][:, None])
    regions = np.where(valid, chars[np.clip(where, 0, len(chars) - 1)], 0)
    edits, end = aligned(pattern, regions, most)
    for i in np.flatnonzero(edits <= most):
        yield int(i), int(left[i] + end[i] - offsets[row[i]]), int(edits[i])


def aligned(pattern: np.ndarray, regions: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between each pattern and any part of its region, and where that part ends.

    ``pattern``: (c, m), ``regions``: (c, w); regions are as wide as the band around the window, and
    0 stands for no character. Edits above ``most`` are not told apart. Numbers stay below
    ``m + w``, a few hundred for any window, so 16 bits hold them.
    """
    c, w = regions.shape
    steps = np.arange(w + 1, dtype=np.int16)
    row = np.zeros((c, w + 1), np.int16)
    alive = np.arange(c)
    for i in range(pattern.shape[1]):
        if i % 8 == 0:  # the least of a row never falls again
            keep = row.min(1) <= most
            if not keep.all():
                row, regions, pattern, alive = row[keep], regions[keep], pattern[keep], alive[keep]
        new = np.empty_like(row)
        new[:, 0] = row[:, 0] + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (regions != pattern[:, i : i + 1]))
        # an insertion costs one for every step to the right
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    edits, end = np.full(c, most + 1, np.int16), np.zeros(c, np.int64)
    end[alive] = row.argmin(1)
    edits[alive] = np.minimum(row[np.arange(len(alive)), end[alive]], most + 1)
    return edits, end


def find_leaks(index: Index, chars: np.ndarray, offsets: np.ndarray) -> list[tuple[int, ...]]:
    """``row, item number, start, end, windows found, windows of the item, least edits`` in row order."""
    hits = _hits(index, chars, offsets)
    dense = _dense(index, *hits)
    row, at, item, place = hits = tuple(x[dense] for x in hits)
    if not len(row):
        return []
    length = (index.first[1:] - index.first[:-1])[item]
    last = np.where(length <= WINDOW, 0, -(-(length - WINDOW) // STRIDE))  # number of the item's last window
    shift = at - place
    # a row, window of the block and band make one number: under 2^63 at any size of text or block
    n_windows = 1 + np.maximum(0, -(-(index.first[1:] - index.first[:-1] - WINDOW) // STRIDE))
    window_at = np.concatenate([[0], np.cumsum(n_windows)])
    low_band = int(shift.min()) // BAND - 1
    n_bands = int(shift.max()) // BAND - low_band + 1
    found: list[tuple[int, ...]] = []
    keys = []
    for back in range(WINDOW // STRIDE + 1):  # the windows that may hold the q-gram
        for tail in (False, True):
            window = last if tail else place // STRIDE - back
            if tail and back:
                continue
            start = np.where(window == last, np.maximum(0, length - WINDOW), window * STRIDE)
            size = np.minimum(length, WINDOW)
            ok = (window >= 0) & (window <= last) & (place >= start) & (place + Q <= start + size)
            if not tail:
                ok &= window < last
            for step in (0, 1):  # the bands that hold the diagonal
                band = shift // BAND - step
                in_band = ok if not step else ok & (shift - (band + 1) * BAND < edit_budget(WINDOW))
                pick = np.flatnonzero(in_band)
                at_window = row[pick] * window_at[-1] + window_at[item[pick]] + window[pick]
                keys.append(at_window * n_bands + (band[pick] - low_band))
    packed = np.concatenate(keys)
    packed, count = np.unique(packed, return_counts=True)
    at_window, band = np.divmod(packed, n_bands)
    row, at_window = np.divmod(at_window, window_at[-1])
    item = np.searchsorted(window_at, at_window, "right") - 1
    key = np.stack([row, item, at_window - window_at[item], band + low_band], 1)
    size = np.minimum(index.first[key[:, 1] + 1] - index.first[key[:, 1]], WINDOW)
    budget = np.maximum(0, np.minimum((size * EDIT_SHARE).astype(np.int64), size // Q - 1))
    enough = count >= size + 1 - Q * (budget + 1)
    key, size, budget = key[enough], size[enough], budget[enough]
    for width in np.unique(size):
        some = key[size == width]
        n_last = np.where(some[:, 1] >= 0, -(-(index.first[some[:, 1] + 1] - index.first[some[:, 1]] - WINDOW) // STRIDE), 0)
        start = np.where(
            some[:, 2] >= np.maximum(n_last, 0),
            np.maximum(0, index.first[some[:, 1] + 1] - index.first[some[:, 1]] - WINDOW),
            some[:, 2] * STRIDE,
        )
        for lo in range(0, len(some), 4096):
            part, from_ = some[lo : lo + 4096], start[lo : lo + 4096]
            for i, stop, edits in _align(index, chars, offsets, part[:, 0], part[:, 1], from_, part[:, 3], int(width), edit_budget(int(width))):
                found.append((int(part[i, 0]), int(part[i, 1]), max(0, stop - int(width)), stop, int(part[i, 2]), edits))
    out: dict[tuple[int, int], list] = {}
    for r, it, lo, hi, window, edits in found:
        seen = out.setdefault((r, it), [lo, hi, set(), edits])
        seen[0], seen[1], seen[3] = min(seen[0], lo), max(seen[1], hi), min(seen[3], edits)
        seen[2].add(window)
    for r, it, lo, hi, edits in _between(index, chars, offsets, hits, set(out)):
        seen = out.setdefault((r, it), [lo, hi, set(), edits])
        seen[0], seen[1], seen[3] = min(seen[0], lo), max(seen[1], hi), min(seen[3], edits)
    lengths = index.first[1:] - index.first[:-1]
    return [
        (r, it, lo, hi, len(ws), len(_windows(int(lengths[it]))), edits) for (r, it), (lo, hi, ws, edits) in sorted(out.items())
    ]


def _report(index):
    """text, doc_id -> doc_id and a row per leaked item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Index(*index.value)
        automaton = _automaton(found.short)
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(1)
            for lo, _, data, offsets in text_slices(batch.column(0)):
                chars, at = _chars(data, offsets)
                for row, item, *rest in find_leaks(found, chars, at) if found.ids else ():
                    rows.append((ids[lo + row].as_py(), found.ids[item], *rest))
                rows += [(ids[lo + row].as_py(), item_id, a, b, 1, 1, 0) for row, item_id, a, b in find_exact(automaton, data, offsets)]
            schema = pa.schema([
                ("doc_id", batch.schema.field(1).type), ("item_id", pa.int64()),
                *((n, pa.int32()) for n in ("start", "end", "windows", "item_windows", "edits")),
            ])
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _drop(index, text_at: int):
    """Rows as they are, without those that leak an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Index(*index.value)
        automaton = _automaton(found.short)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for lo, _, data, offsets in text_slices(batch.column(text_at)):
                chars, at = _chars(data, offsets)
                clean[[lo + row for row, *_ in (find_leaks(found, chars, at) if found.ids else ())]] = False
                clean[[lo + row for row, *_ in find_exact(automaton, data, offsets)]] = False
            yield batch.filter(pa.array(clean))

    return run


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    held: list[tuple[int | None, str]] = []
    chars = 0
    items = benchmark.select(F.col(id_col).cast("bigint"), F.col(text_col)).where(F.col(text_col).rlike(r"[\p{L}\p{N}]"))
    for item_id, text in items.toLocalIterator():
        if held and chars + len(text) > BLOCK_CHARS:
            yield build_index(held)
            held, chars = [], 0
        held.append((item_id, text))
        chars += len(text)
    if held:
        yield build_index(held)


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start, end, windows, item_windows, edits``: a row per document and item found in it.

    ``start`` and ``end`` bound all windows found (``start`` may be off by the edits of the first);
    ``edits`` is the least of any window. ``windows`` of ``item_windows`` are those that start every
    ``STRIDE``: 0 if the part found lies between them.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, {LEAKS}"
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"))
    out = spark.createDataFrame([], schema)
    for index in _blocks(benchmark, item_col, item_text_col):
        out = out.unionByName(texts.mapInArrow(_report(spark.sparkContext.broadcast(tuple(index))), schema))
    return out


def drop_leaking(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns, no shuffle."""
    spark, schema = docs.sparkSession, docs.schema
    for index in _blocks(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(_drop(spark.sparkContext.broadcast(tuple(index)), docs.columns.index(text_col)), schema)
    return docs
