"""WARC archives with revisit records, written and read through Spark's own readers and writers.

``write_archive`` puts one record per page: the full response, or a ``revisit`` record that
refers to the response holding the same payload. Only headers (id, digest, length) are
shuffled to find repeats; the digest groups of two and more are written as a table, and the
pages are joined to that table (AQE splits a hot digest, whose table side is one row).
Payloads move once, to fill archive files of bounded size. A record is one line of Spark's
text writer, whose separator is the blank lines that end a WARC record, so every part file
is a plain ``.warc`` file. ``read_archive`` takes each file whole (bounded by
``archive_bytes``) and walks its records by their Content-Length, so payloads may hold
anything, record separators too.

Nulls and ties: a null payload is empty; a null url leaves out the target header; a null
page id counts as smallest. Of equal payloads the largest page id is the response; rows
that share that id and payload are all responses. Control characters in a url are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.models import materialize
from quarry.session import scratch_path

CRLF = "\r\n"
MIN_PAYLOAD = 1000
ARCHIVE_BYTES = 8 << 20
RECORD_DATE = "2024-01-01T00:00:00Z"
READ_SCHEMA = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)


def _headers(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    return pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
    ).select("*", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").cast("bigint").alias("bytes"))


def original_responses(headers: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``digest, bytes, response_id`` of every payload of ``min_payload`` bytes that occurs more than once."""
    return (
        headers.where(F.col("bytes") >= min_payload)
        .groupBy("digest", "bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("response_id"))
        .where("n > 1")
        .select("digest", "bytes", "response_id")
    )


def _record(date: str):
    """The WARC record of a row as one string, without the blank lines that end it."""

    def line(name: str, value):
        return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))

    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    page = F.col("page_id").cast("string")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type"), F.lit(CRLF)),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(page, F.lit("none")), F.lit(f">{CRLF}")),
        F.lit(f"WARC-Date: {date}{CRLF}"),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x1F\x7F]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF)),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string"), F.lit(CRLF)),
        F.when(
            revisit,
            F.concat(
                F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}"),
                F.lit("WARC-Refers-To: <urn:page:"),
                F.col("response_id").cast("string"),
                F.lit(f">{CRLF}"),
            ),
        ).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(CRLF + CRLF),
        block,
    )


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_payload: int = MIN_PAYLOAD,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = RECORD_DATE,
) -> None:
    """Write one WARC record per page below ``path``; files hold about ``archive_bytes`` before compression.

    A single record larger than that has a file's share to itself. Files are gzip members.
    """
    headers = _headers(pages, id_col, url_col, payload_col)
    kept = materialize(headers.select("page_id", "digest", "bytes"), "warc-headers")
    repeats = materialize(original_responses(kept, min_payload), "warc-responses")
    total = kept.agg(F.sum(F.col("bytes") + 600)).first()[0] or 0
    revisit = F.col("response_id").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("response_id"), F.lit(False))
    joined = headers.join(repeats, ["digest", "bytes"], "left").withColumn(
        "record_type", F.when(revisit, "revisit").otherwise("response")
    )
    records = joined.select(F.xxhash64("page_id", "url", "digest").alias("spread"), _record(date).alias("value"))
    files = max(1, -(-int(total) // archive_bytes))
    records.repartition(files, "spread").select("value").write.option("lineSep", CRLF * 2).option(
        "compression", "gzip"
    ).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of one archive file."""
    at, end = 0, len(data)
    while at < end:
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {name.lower(): value for name, _, value in (x.partition(": ") for x in lines[1:])}
        begin = stop + 4
        length = int(headers["content-length"])
        yield headers, data[begin : begin + length]
        at = begin + length + 4


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import gzip
    import hashlib

    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])
    for batch in batches:
        for content in batch.column(0):
            rows: list[tuple] = []
            for headers, block in parse_records(gzip.decompress(content.as_py())):
                payload = block.partition(b"\r\n\r\n")[2]
                said = headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                if kind == "revisit":
                    size, digest, payload = int(headers["x-payload-length"]), said, None
                else:
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    if digest != said:
                        raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
                rows.append((
                    _page(headers["warc-record-id"]), headers.get("warc-target-uri"), kind, size, digest,
                    _page(headers.get("warc-refers-to")), payload,
                ))
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``; a response's length and digest are computed from the payload as read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_read_files, READ_SCHEMA)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with every revisit's payload filled in from the response it refers to."""
    originals = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest"), F.col("payload").alias("original")
    ).dropDuplicates(["refers_to", "payload_digest"])
    return (
        records.join(originals, ["refers_to", "payload_digest"], "left")
        .withColumn("payload", F.coalesce("payload", "original"))
        .select(*records.columns)
    )


def archive_pages(spark: SparkSession, pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder (or ``path``) and read them back."""
    path = path or scratch_path(spark, "warc")
    write_archive(pages, path, **options)
    return read_archive(spark, path)
