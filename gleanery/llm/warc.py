"""WARC archives with revisit resolution.

Headers (page, payload digest, length) are grouped by digest with map-side combine; the largest page_id of each group of
equal payloads of ``MIN_REVISIT`` bytes or more keeps its payload, the others become revisit records that refer to it
and carry headers only.  Payloads meet the list of revisits in an anti-join by page and digest, a key of one row, so a
payload that a third of all pages share lies in no hot partition: grouped by digest are headers alone.

Archives are written and read by Spark's own file sources, so any file system of the cluster will do and a lost task
leaves nothing behind.  Every record is a gzip member of its own.  The text writer takes the bytes of a few members as a
row and ends it with its row separator, a zero byte, which is the last byte of the last member (the upper byte of its
length; after a record of 16 MB or more, of an empty member).  A row holds ``ROW_BYTES`` of members or one that is larger
and a part file ``PART_ROWS`` rows, so parts are bounded in bytes, and reading back inflates one member at a time.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.batches import values
from gleanery.llm.common import checkpoint, shared_path
from gleanery.operators.joins import BROADCAST_ROWS

MIN_REVISIT = 1000
ROW_BYTES = 4 << 20
PART_ROWS = 8
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def headers(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload_digest, payload_bytes, refers_to, refers_url: refers_to is null for a response.

    Null html is an empty payload.  Rows that repeat the largest page_id of their group are responses, too.  A row
    without page_id never is referred to; with a null page_id it refers to the group's largest, if there is one.
    """
    h = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("p"))
    h = h.select("page_id", "url", F.sha1("p").alias("payload_digest"), F.octet_length("p").cast("long").alias("payload_bytes"))
    top = h.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("payload_digest").agg(F.max(F.struct("page_id", "url")).alias("top"))
    h = h.join(top.select("payload_digest", F.col("top.page_id").alias("top_id"), F.col("top.url").alias("top_url")), "payload_digest", "left")
    revisit = F.col("top_id").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("top_id"), F.lit(False))
    return h.select("page_id", "url", "payload_digest", "payload_bytes", F.when(revisit, F.col("top_id")).alias("refers_to"), F.when(revisit, F.col("top_url")).alias("refers_url"))


def _clean(c):
    """A header's value: one line."""
    return F.regexp_replace(c, r"[\r\n]+", " ")


def records(pages: DataFrame, min_bytes: int = MIN_REVISIT, date: str = DATE) -> DataFrame:
    """record: the text of each record up to, not with, the two line ends that close it.

    Other columns are left behind.  Null url is empty, null html an empty payload; repeated rows have a record each."""
    h = headers(pages, min_bytes)
    p = F.coalesce(F.col("html").cast("string"), F.lit(""))
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), p.alias("payload")).withColumn("payload_digest", F.sha1(F.encode("payload", "UTF-8"))).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # what is kept: small payloads as they are, of the others those that no header turns into a revisit
    gone = h.where("refers_to is not null").select("page_id", "payload_digest").distinct()
    gone = checkpoint(gone.select(F.col("page_id").alias("g_id"), F.unhex("payload_digest").alias("g_digest")))
    if gone.count() <= BROADCAST_ROWS:  # of a number and 20 bytes each: payloads stay where they are
        gone = F.broadcast(gone)
    kept = full.join(gone, F.col("page_id").eqNullSafe(F.col("g_id")) & (F.unhex("payload_digest") == F.col("g_digest")), "left_anti")
    common = lambda kind: F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit(":"), F.col("payload_digest"), F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), _clean(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\nX-Page-Id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"),
    )
    response = kept.select(F.concat(common("response"), F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"), F.col("payload")).alias("record"))
    revisit = h.where("refers_to is not null").select(
        F.concat(common("revisit"), F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(":"), F.col("payload_digest"), F.lit(">\r\nWARC-Refers-To-Target-URI: "), _clean(F.col("refers_url")), F.lit("\r\nContent-Length: 0\r\n\r\n")).alias("record")
    )
    return response.union(revisit)


def _members(row_bytes: int):
    """Rows of gzip members, a member a record, without the last byte, which is zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            data = b"".join(held)
            if data[-1]:
                data += zlib.compress(b"", wbits=31)
            return pa.record_batch([pa.array([data[:-1]], pa.binary())], names=["members"])

        for batch in batches:
            for record in values(batch.column(0), 32):
                member = zlib.compress(record + b"\r\n\r\n", wbits=31)
                held.append(member)
                size += len(member)
                if size >= row_bytes:
                    yield row()
                    held.clear()
                    size = 0
        if held:
            yield row()

    return run


def write(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT, date: str = DATE, row_bytes: int = ROW_BYTES, part_rows: int = PART_ROWS) -> None:
    members = records(pages, min_bytes, date).select(F.encode("record", "UTF-8")).mapInArrow(_members(row_bytes), "members binary")
    # a string of any bytes: neither the cast nor the writer looks at them
    members.select(F.col("members").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", part_rows).text(path)


_HEAD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def members(data: memoryview) -> Iterator[bytes]:
    """The gzip members of a file, inflated one at a time."""
    while len(data):
        z = zlib.decompressobj(31)
        out = [z.decompress(data[: 1 << 16])]
        at = min(len(data), 1 << 16)
        while not z.eof:
            if at >= len(data):
                raise ValueError("cut off in a member")
            out.append(z.decompress(data[at : at + (1 << 16)]))
            at += min(1 << 16, len(data) - at)
        yield b"".join(out)
        data = data[at - len(z.unused_data) :]


def parse(record: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """Headers (names in lower case) and body."""
    if not record.startswith(b"WARC/"):
        raise ValueError("no record")
    end = record.index(b"\r\n\r\n") + 4
    head = {k.strip().lower(): v.strip() for k, v in _HEAD.findall(record, record.index(b"\r\n") + 2, end)}
    n = int(head[b"content-length"])
    if record[end + n :] != b"\r\n\r\n":
        raise ValueError("a record doesn't end where it says")
    return head, record[end : end + n]


def _read(digest: bool):
    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to"] + ([] if digest else ["payload"])
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()] + ([] if digest else [pa.string()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column(0):
                rows, size = [], 0
                for record in members(memoryview(blob.as_buffer())):
                    if not record:
                        continue
                    head, body = parse(record)
                    kind = head[b"warc-type"].decode()
                    said = head[b"warc-payload-digest"].decode().removeprefix("sha1:")
                    if kind == "response" and hashlib.sha1(body).hexdigest() != said:
                        raise ValueError(f"payload of page {head[b'x-page-id']} doesn't have its digest")
                    to = head.get(b"warc-refers-to", b"").decode().removeprefix("<urn:page:").partition(":")[0]
                    page = head[b"x-page-id"].decode()
                    row = (int(page) if page else None, head[b"warc-target-uri"].decode(), kind, said, int(head[b"x-payload-length"]), int(to) if to else None)
                    rows.append(row if digest else (*row, body.decode("utf-8", "replace")))
                    size += 0 if digest else len(body)
                    if len(rows) >= 500 or size >= ROW_BYTES:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """page_id, url, record_type, payload_digest, payload_bytes, refers_to and, if asked for, payload (of a revisit
    empty).  Digests of responses are verified."""
    shape = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long" + (", payload string" if payload else "")
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(_read(not payload), shape)


def archive(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write all pages as archives and read them back (without payloads).  An empty table gives an empty result."""
    path = path or shared_path(pages.sparkSession, f"warc-{uuid.uuid4().hex}")
    write(pages, path, min_bytes)
    return read(pages.sparkSession, path, payload=False)
