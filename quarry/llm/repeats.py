"""Removal of repeated byte strings: suffix ranks at growing lengths, until unique or past the threshold.

A byte goes if a string of ``LENGTH`` (200) bytes that covers it also starts anywhere else in
the table. Sorting pairs of ranks of every byte position would move each position several
times (see the README for the figures); here the same refinement runs on few positions, and
names of strings stand for their ranks:

1. Length 100. In every window of 200 bytes the 100-byte string with the least hash is its
   anchor. The choice depends on the window's bytes alone, so equal windows have equal
   anchors at equal places, and neighbouring windows share them: about one position in fifty
   is an anchor. Anchors are named by their string; those whose name is unique leave, and
   with them all their windows.
2. All of an anchor's windows at once. An anchor's context is the run of bytes that its
   windows cover. Anchors of equal name and context are ranked together; where a context
   occurs twice, all its windows are repeated and it is settled.
3. Length 200. What is left are anchors whose string repeats in different contexts (the ends
   of a repeat). Their windows are named one by one, by the pair of names at the start and
   100 bytes on; sorted, a window whose pair occurs twice is repeated.

Names are 64-bit hashes compared only under the same anchor name. Copies are combined before
each shuffle; a name with over ``SPLIT`` different contexts is settled by grouping window names
in Spark, in place of one task. Texts move twice: to the anchors that need their bytes, and
for the cut.

Nulls and ties: a null text is empty (0 bytes, the digest of no bytes). Texts under 200 bytes
lose nothing. Documents are told apart by id and text; rows equal in both are copies of each
other and lose their repeated bytes each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bytes_np import mix64, powers, text_slices
from quarry.operators.models import materialize

LENGTH = 200
SPLIT = 2048
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Names:
    """Names of substrings of some bytes, from sums of powers."""

    def __init__(self, data: np.ndarray, base: np.uint64) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data)), out=self.sums[1:])
        self.inverse = powers(np.uint64(pow(int(base), -1, 1 << 64)), len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start])

    def all_of(self, length: int) -> np.ndarray:
        """Names of every string of one length, by start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix64((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` values in a row; the first of equal ones."""
    n = len(values) - width + 1
    at = np.arange(len(values), dtype=np.int32)
    span = 1
    while span * 2 <= width:
        left, right = at[: len(at) - span], at[span:]
        at = np.where(values[left] <= values[right], left, right)
        span *= 2
    left, right = at[:n], at[width - span : width - span + n]
    return np.where(values[left] <= values[right], left, right)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``row, low, windows, offset, name, context`` of each anchor of the texts.

    Its windows start at ``low .. low + windows - 1`` (in the text); the anchor itself is at
    ``low + offset``.
    """
    gram = length // 2
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none, none
    names = _Names(data, _B1)
    grams = names.all_of(gram)
    least = _least(grams, length - gram + 1)  # by window start
    starts = np.arange(len(least), dtype=np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(starts)]  # of the text that holds the start
    inside = starts + length <= ends
    if not inside.any():
        return none, none, none, none, none, none
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
    low = np.flatnonzero(new)
    many = np.diff(np.append(low, len(starts)))
    pick = inside[low]
    low, many = low[pick], many[pick]
    place = least[low].astype(np.int64)
    row = np.searchsorted(offsets, low, "right") - 1
    # A run of windows never passes from one text to the next: between them are starts without a window.
    context = _Names(data, _B2).of(low, low + many - 1 + length)
    context = mix64(context + (place - low).astype(np.uint64) * np.uint64(1 << 20) + many.astype(np.uint64))
    return row, low - offsets[row], many, place - low, grams[place].view(np.int64), context.view(np.int64)


def _count_anchors(length: int):
    schema = pa.schema([("name", pa.int64()), ("context", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                *_, name, context = anchors(data, offsets, length)
                order = np.lexsort((context, name))
                name, context = name[order], context[order]
                new = np.ones(len(name), bool)
                new[1:] = (name[1:] != name[:-1]) | (context[1:] != context[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(name)))
                yield pa.RecordBatch.from_arrays([pa.array(name[at]), pa.array(context[at]), pa.array(n)], schema=schema)

    return run


def _list_anchors(length: int):
    schema = pa.schema([("doc", pa.int64()), ("low", pa.int32()), ("windows", pa.int16()), ("offset", pa.int16()), ("name", pa.int64()), ("context", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(1).to_numpy()
            for lo, _, data, offsets in text_slices(batch.column(0)):
                row, low, many, offset, name, context = anchors(data, offsets, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[lo + row]), pa.array(low, pa.int32()), pa.array(many, pa.int16()),
                        pa.array(offset, pa.int16()), pa.array(name), pa.array(context),
                    ],
                    schema=schema,
                )

    return run


def _take_contexts(length: int):
    """text, doc, open (list of struct low, windows, name, n, parts) -> the bytes of the contexts."""
    schema = pa.schema([
        ("doc", pa.int64()), ("low", pa.int32()), ("windows", pa.int16()), ("name", pa.int64()), ("n", pa.int64()), ("split", pa.bool_()),
        ("bytes", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, doc, wanted in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.as_buffer()
                for w in wanted:
                    end = w["low"] + w["windows"] - 1 + length
                    rows.append((doc, w["low"], w["windows"], w["name"], w["n"], w["split"], data[w["low"] : end].to_pybytes()))
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _window_names(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window of some contexts: its context's row, its number in the context, its name."""
    many = table.column("windows").to_numpy().astype(np.int64)
    blob = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    begins = np.cumsum(many + length - 1) - (many + length - 1)
    owner = np.repeat(np.arange(len(many)), many)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    start = begins[owner] + number
    names, half = _Names(blob, _B2), length // 2
    # the pair of the halves' names, that is of the ranks at the start and half a length on
    pair = mix64(names.of(start, start + half) * np.uint64(3) + names.of(start + half, start + length))
    return owner, number, mix64(pair + table.column("name").to_numpy().view(np.uint64)[owner])


_RUN = pa.schema([("doc", pa.int64()), ("low", pa.int32()), ("windows", pa.int32())])


def _runs(table: pa.Table, owner: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
    """Runs of consecutive repeated windows (sorted by owner and number)."""
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (number[1:] != number[:-1] + 1)
    at = np.flatnonzero(new)
    low = table.column("low").to_numpy()[owner[at]] + number[at]
    return pa.RecordBatch.from_arrays(
        [pa.array(table.column("doc").to_numpy()[owner[at]]), pa.array(low, pa.int32()), pa.array(np.diff(np.append(at, len(owner))), pa.int32())],
        schema=_RUN,
    )


def _settle(length: int):
    """Contexts sorted by name -> runs of repeated windows of the contexts that occur once."""
    from quarry.llm.ngramjoin import _by_key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, 1, 4000):
            owner, number, name = _window_names(table, length)
            n = table.column("n").to_numpy()
            _, which = np.unique(name, return_inverse=True)
            seen = np.bincount(which, n[owner])
            repeated = np.flatnonzero((seen[which] > 1) & (n[owner] == 1))
            yield _runs(table, owner[repeated], number[repeated])

    return run


def _name_windows(length: int):
    schema = pa.schema([("doc", pa.int64()), ("low", pa.int32()), ("n", pa.int64()), ("window", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                table = pa.Table.from_batches([batch.slice(at, 2000)])
                owner, number, name = _window_names(table, length)
                low = table.column("low").to_numpy()[owner] + number
                yield pa.RecordBatch.from_arrays(
                    [pa.array(table.column("doc").to_numpy()[owner]), pa.array(low, pa.int32()), pa.array(table.column("n").to_numpy()[owner]), pa.array(name.view(np.int64))],
                    schema=schema,
                )

    return run


def _cut(length: int):
    """text, doc_id, repeats (list of struct low, windows) -> n_bytes, n_removed, n_spans, kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([
                ("doc_id", batch.schema.field(1).type), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()),
            ])
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for text, repeats in zip(part.column(0), part.column(2)):
                    data = text.as_buffer().to_pybytes() if text.is_valid else b""
                    if not repeats.is_valid or not len(repeats):
                        rows.append((len(data), 0, 0, data))
                        continue
                    edge = np.zeros(len(data) + 1, np.int32)
                    low = np.array([r["low"] for r in repeats.as_py()], np.int64)
                    many = np.array([r["windows"] for r in repeats.as_py()], np.int64)
                    np.add.at(edge, low, 1)
                    np.add.at(edge, low + many - 1 + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    rows.append((len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), *(pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns))], schema=schema
                )

    return run


def repeated_windows(texts: DataFrame, length: int = LENGTH, split: int = SPLIT) -> DataFrame:
    """``doc, low, windows``: runs of window starts whose ``length`` bytes occur elsewhere. ``texts``: ``text, doc``."""
    counted = texts.select("text").mapInArrow(_count_anchors(length), "name long, context long, n long")
    ranked = (
        counted.repartition("name")
        .groupBy("name", "context")
        .agg(F.sum("n").alias("n"))
        .selectExpr(
            "name", "context", "n", "sum(n) OVER (PARTITION BY name) AS total", "count(1) OVER (PARTITION BY name) AS contexts"
        )
        .where("total > 1")
        .select("name", "context", "n", "contexts")
    )
    ranked = materialize(ranked, "repeat-ranks")
    listed = texts.select("text", "doc").mapInArrow(
        _list_anchors(length), "doc long, low int, windows short, offset short, name long, context long"
    )
    found = materialize(
        listed.join(ranked, ["name", "context"]).select("doc", "low", "windows", "name", "context", "n", "contexts"), "repeat-anchors"
    )
    whole = found.where("n > 1").select("doc", "low", F.col("windows").cast("int").alias("windows"))

    one = (
        found.where("contexts > 1")
        .groupBy("name", "context")
        .agg(F.min(F.struct("doc", "low", "windows", "n", (F.col("contexts") > split).alias("split"))).alias("one"))
        .select("one.*", "name")
    )
    wanted = materialize(
        one.groupBy("doc").agg(F.collect_list(F.struct("low", "windows", "name", "n", "split")).alias("open")), "repeat-open"
    ).withColumnRenamed("doc", "_doc")
    contexts = materialize(
        texts.join(wanted, F.col("doc") == F.col("_doc"))
        .select(F.col("text").cast("binary"), "doc", "open")
        .mapInArrow(_take_contexts(length), "doc long, low int, windows short, name long, n long, split boolean, bytes binary"),
        "repeat-contexts",
    )
    columns = ["name", "doc", "low", "windows", "n", "bytes"]
    settled = (
        contexts.where("not split")
        .select(*columns)
        .repartition("name")
        .sortWithinPartitions("name")
        .mapInArrow(_settle(length), "doc long, low int, windows int")
    )
    named = contexts.where("split").select(*columns).mapInArrow(_name_windows(length), "doc long, low int, n long, window long")
    again = materialize(named.groupBy("window").agg(F.sum("n").alias("seen")).where("seen > 1").select("window"), "repeat-names")
    apart = named.where("n = 1").join(again, "window", "left_semi").select("doc", "low", F.lit(1).alias("windows"))
    return whole.union(settled).union(apart)


def cut_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", split: int = SPLIT
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(
        F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("doc"), F.col(id_col).alias("doc_id")
    )
    runs = repeated_windows(texts.select("text", "doc"), length, split)
    per_doc = materialize(
        runs.groupBy("doc").agg(F.collect_list(F.struct("low", "windows")).alias("repeats")), "repeat-runs"
    ).withColumnRenamed("doc", "_doc")
    return (
        texts.join(per_doc, F.col("doc") == F.col("_doc"), "left")
        .select(F.col("text").cast("binary").alias("text"), "doc_id", "repeats")
        .mapInArrow(_cut(length), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    )

