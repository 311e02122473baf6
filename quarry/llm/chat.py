"""Chat formatting with typed content parts.

A turn's content is an ordered list of parts: ``text``, ``image``, ``audio`` or ``document``.
``PartVisitor`` flattens them to one string: text is escaped, every other part becomes a
placeholder in its place, with an attachment reference and the number of tokens that the
placeholder will expand to. The template marks turns with control strings; control strings
(and those of other common templates) inside texts, roles and references are broken up with
a backslash, which ``unescape`` undoes exactly.

Turns are formatted row by row and written as one piece per turn with the place of the text
that counts for the loss, so no conversation is ever held whole. Reading back, each
conversation's pieces pass in order through running digests in one task at a time, row by
row; a digest of a whole conversation has no parallel form.

Nulls and ties: a null text is empty, a null role is the empty role, a null turn comes
first, a null conversation id is a conversation of its own. Rows of equal turn are ordered
by role, then text; repeated rows are kept. A null or empty list of parts gives an empty text.
An unknown part type raises ValueError. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.models import materialize

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What starts or is a control string, here or in common templates; the backslash itself too.
_CONTROL = re.compile(r"\\|<(?=\||/?s>|/?SYS|<SYS|start_of|end_of)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
PIECES = (
    "conv_id long, turn long, role string, piece string, text_start int, text_end int, in_loss boolean, "
    "attachments array<struct<place:int,kind:string,uri:string,tokens:int>>, extra_tokens long"
)


def escape(text: str) -> str:
    """``text`` with a backslash put into every control string (and before every backslash)."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


@dataclass
class PartVisitor:
    """Flattens the parts of one turn. ``patch``: pixels a side of an image token."""

    patch: int = 28
    audio_tokens_per_second: float = 12.5
    tokens_per_page: int = 256
    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    length: int = 0

    def visit(self, part: Mapping) -> None:
        kind = part.get("type")
        visit = getattr(self, f"visit_{kind}", None) if kind in ("text", "image", "audio", "document") else None
        if visit is None:
            raise ValueError(f"unknown part type {kind!r}")
        visit(part)

    def _put(self, s: str) -> None:
        self.out.append(s)
        self.length += len(s)

    def visit_text(self, part: Mapping) -> None:
        self._put(escape(part.get("text") or ""))

    def _attach(self, kind: str, part: Mapping, tokens: int) -> None:
        place, uri = self.length, part.get("uri") or ""
        self._put(f"<|{kind}:{len(self.attachments)}|>")
        self.attachments.append({"place": place, "kind": kind, "uri": uri, "tokens": tokens})

    def visit_image(self, part: Mapping) -> None:
        side = lambda n: max(1, math.ceil((n or 0) / self.patch))
        self._attach("image", part, side(part.get("width")) * side(part.get("height")))

    def visit_audio(self, part: Mapping) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * self.audio_tokens_per_second)))

    def visit_document(self, part: Mapping) -> None:
        self._attach("document", part, max(1, part.get("pages") or 1) * self.tokens_per_page)


def format_turn(role: str | None, parts: Iterable[Mapping]) -> tuple[str, int, int, list[dict], int]:
    """``piece, text_start, text_end`` (code points in the piece), attachments, their tokens."""
    visitor = PartVisitor()
    for part in parts:
        visitor.visit(part)
    head = f"{TURN}{escape(role or '')}{TEXT}"
    body = "".join(visitor.out)
    for a in visitor.attachments:
        a["place"] += len(head)
    return head + body + END, len(head), len(head) + len(body), visitor.attachments, sum(a["tokens"] for a in visitor.attachments)


def _format_batches(loss_role: str):
    schema = pa.schema([
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("piece", pa.string()), ("text_start", pa.int32()),
        ("text_end", pa.int32()), ("in_loss", pa.bool_()),
        ("attachments", pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("uri", pa.string()), ("tokens", pa.int32())]))),
        ("extra_tokens", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                piece, start, end, attached, tokens = format_turn(r["role"], r["parts"] or ())
                rows.append((r["conv_id"], r["turn"], r["role"], piece, start, end, r["role"] == loss_role, attached, tokens))
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def text_parts(conversations: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """Plain texts as turns of one text part: ``conv_id, turn, role, parts``."""
    none = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *[F.lit(None).cast(t).alias(n) for n, t in none.items()],
    )
    return conversations.select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.col(role_col).alias("role"),
        F.array(part).alias("parts"),
    )


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One formatted piece per turn (columns ``PIECES``) from ``conv_id, turn, role, parts``.

    A conversation's text is its pieces joined in the order of :func:`ordered`.
    """
    return turns.select("conv_id", "turn", "role", "parts").mapInArrow(_format_batches(loss_role), PIECES)


def ordered(pieces: DataFrame) -> DataFrame:
    """Each conversation in one partition, its pieces in order and next to each other; equal turns by role, then by text as it was."""
    body = F.substring("piece", F.lit(1), F.char_length("piece") - len(END))
    text = F.regexp_replace(body, r"(?s)\\(.)", "$1").alias("text")
    rows = pieces.repartition("conv_id").select("*", text)
    return rows.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), "text").drop("text")


def parse_piece(piece: str) -> tuple[str, str]:
    """Role and unescaped text of a turn's piece; placeholders stay as they are."""
    if not (piece.startswith(TURN) and piece.endswith(END)):
        raise ValueError("not a formatted turn")
    role, found, body = piece[len(TURN) : len(piece) - len(END)].partition(TEXT)
    if not found:
        raise ValueError("a turn without text mark")
    return unescape(role), unescape(body)


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, piece: str, start: int, end: int, in_loss: bool) -> None:
        role, text = parse_piece(piece)
        self.n_turns += 1
        self.formatted_chars += len(piece)
        self.turns.update(f"{role}\n{text}\n".encode())
        if in_loss:
            under = unescape(piece[start:end])
            self.loss_chars += len(under)
            self.loss.update(under.encode())

    def row(self) -> tuple:
        return (
            self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars,
        )


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    current, state, rows = None, None, []
    for batch in batches:
        for conv, piece, start, end, in_loss in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or conv != current:
                if state is not None:
                    rows.append((current, *state.row()))
                current, state = conv, _Digest()
            state.add(piece, start, end, in_loss)
        if len(rows) > 5000:
            yield out(rows)
            rows = []
    if state is not None:
        rows.append((current, *state.row()))
    if rows:
        yield out(rows)


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """Per conversation: ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, parsed from the pieces."""
    return ordered(pieces.select("conv_id", "turn", "role", "piece", "text_start", "text_end", "in_loss")).select(
        "conv_id", "piece", "text_start", "text_end", "in_loss"
    ).mapInArrow(
        _digest_batches,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def write_formatted(turns: DataFrame, spark: SparkSession) -> DataFrame:
    """Format, write to the shared folder, and return the written pieces."""
    return materialize(format_conversations(turns), "chat")
