"""WARC archives: writing captures, reading them back, and assembling transactions.

A capture is a request, a response (or a revisit, when an equal payload is
stored elsewhere) and a metadata record; request and metadata name the
response in ``WARC-Concurrent-To``.  Records are built by Spark expressions
and written by Spark's text writer: a row is the records of one capture, whose
last line feed is the writer's row end, so the files are WARC files byte for
byte (one gzip member each).  Rows are dealt out so that a file holds about
``file_bytes``.

Reading parses each archive record by record by its Content-Length, in any
order and from any writer.  ``transactions`` joins requests and metadata to
responses through the concurrent-to identifiers, and revisits to the response
they refer to, and gives one nested row per capture.

Payloads are equal if their SHA-1 and length are.  Of equal payloads of at
least ``min_bytes`` the capture with the largest page_id (of repeated rows,
the last) is the response.

Defined cases: null html is empty; a null url writes no target URI; line ends
in an url are percent-encoded; a null page_id is smaller than any; repeated
rows are captures of their own; further columns are ignored; metadata or
requests without a response make no row.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlake.llm.common import stored

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 32 << 20
# Fixed value: the profile that marks a revisit of an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "record_id string, type string, concurrent_to string, refers_to string, uri string, declared_digest string, payload_bytes long, payload_sha1 string, fields map<string,string>"


def _lines(*lines):
    """Header lines of (name, value) pairs and plain strings; pairs with a null value are left out."""
    made = [F.lit(x) if isinstance(x, str) else F.concat(F.lit(x[0] + ": "), x[1]) for x in lines]
    return F.concat(F.concat_ws(CRLF, *made), F.lit(CRLF))


def _record(kind: str, record_id, content_type: str, block, *more):
    head = _lines("WARC/1.1", ("WARC-Type", F.lit(kind)), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(DATE)), *more,
                  ("Content-Type", F.lit(content_type)), ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(CRLF), block, F.lit(CRLF + CRLF))


def _urn(kind: str, serial, page_id, sha1):
    h = F.md5(F.concat_ws(":", F.lit(kind), serial.cast("string"), F.coalesce(page_id.cast("string"), F.lit("null")), sha1))
    return F.concat(F.lit("<urn:uuid:"), *[F.concat(F.substring(h, a, n), F.lit(end)) for a, n, end in ((1, 8, "-"), (9, 4, "-"), (13, 4, "-"), (17, 4, "-"), (21, 12, ">"))])


def captures(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """``pages`` (page_id, url, html) with payload digest and size, a serial number, and the response they revisit."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    read = slim.withColumns({"sha1": F.sha1(F.encode("html", "UTF-8")), "size": F.octet_length("html").cast("long"), "serial": F.monotonically_increasing_id()})
    # Stored with the pages: a second scan may be split otherwise and number the rows otherwise.
    known = stored(read, "captures", compression="zstd")
    owners = known.where(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(F.max(F.struct("page_id", "serial")).alias("first"), F.count("*").alias("n")).where("n > 1")
    # Written, so that a hot payload's partition of the join can be split.
    revisits = known.join(stored(owners, "owners"), ["sha1", "size"]).where("serial <> first.serial").select("serial", "first")
    return known.join(stored(revisits, "revisits"), "serial", "left")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 1000, file_bytes: int = FILE_BYTES) -> None:
    """Write the captures of ``pages`` to WARC files (gzip) in the folder ``path``."""
    rows = captures(pages, min_bytes)
    total = pages.select(F.sum(F.octet_length(F.col("html").cast("string")) + 1500)).first()[0] or 0
    own = lambda kind: _urn(kind, F.col("serial"), F.col("page_id"), F.col("sha1"))
    uri = ("WARC-Target-URI", F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1")))
    head = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "), F.col("size").cast("string"), F.lit(CRLF + CRLF))
    response = _record("response", own("response"), "application/http; msgtype=response", F.concat(head, F.col("html")), uri, digest)
    first = _urn("response", F.col("first.serial"), F.col("first.page_id"), F.col("sha1"))
    revisit = _record("revisit", own("response"), "application/http; msgtype=response", head, uri, digest, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", first))
    request = _record("request", own("request"), "application/http; msgtype=request", F.lit("GET / HTTP/1.1" + CRLF + CRLF), uri, ("WARC-Concurrent-To", own("response")))
    about = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF))
    metadata = _record("metadata", own("metadata"), "application/warc-fields", about, uri, ("WARC-Concurrent-To", own("response")))
    whole = F.concat(request, F.when(F.col("first").isNull(), response).otherwise(revisit), metadata)
    lines = rows.select(F.substring(whole, F.lit(1), F.length(whole) - 1).alias("value"))
    lines.repartition(max(1, -(-total // file_bytes))).write.option("compression", "gzip").text(path)


def records(stream):
    """(headers with lower-case names, block) of each record of an open archive."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


def _row(headers: dict, block: bytes) -> dict:
    kind = headers["warc-type"]
    payload, fields = None, None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
    elif kind == "metadata":
        fields = [(a.strip(), b.strip()) for a, _, b in (x.partition(":") for x in block.decode().splitlines() if x)]
    return {
        "record_id": headers["warc-record-id"], "type": kind, "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"), "uri": headers.get("warc-target-uri"),
        "declared_digest": headers.get("warc-payload-digest"), "payload": payload,
        "payload_bytes": None if payload is None else len(payload),
        "payload_sha1": None if payload is None else hashlib.sha1(payload).hexdigest(), "fields": fields,
    }


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives in the folder ``path``; payloads (bytes) of responses only if asked for."""
    types = {"record_id": pa.string(), "type": pa.string(), "concurrent_to": pa.string(), "refers_to": pa.string(), "uri": pa.string(), "declared_digest": pa.string(),
             "payload_bytes": pa.int64(), "payload_sha1": pa.string(), "fields": pa.map_(pa.string(), pa.string())}
    schema = RECORDS
    if with_payload:
        types["payload"], schema = pa.binary(), RECORDS + ", payload binary"
    columns = pa.schema(list(types.items()))

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_buffer()
                stream = io.BufferedReader(gzip.GzipFile(fileobj=pa.BufferReader(data)) if data[:2].to_pybytes() == b"\x1f\x8b" else pa.BufferReader(data))
                held, size = [], 0
                for headers, block in records(stream):
                    held.append(_row(headers, block))
                    size += len(block) if with_payload else 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=columns)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, schema)


def transactions(found: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, uri, type, payload, refers_to (of the original), request and metadata."""
    parts = stored(found, "records")
    more = ["payload"] if "payload" in found.columns else []
    captured = parts.where("type in ('response', 'revisit')")
    requests = parts.where("type = 'request'").select(F.col("concurrent_to").alias("record_id"), F.struct(F.col("record_id").alias("id"), "uri").alias("request"))
    about = parts.where("type = 'metadata'").select(F.col("concurrent_to").alias("record_id"), F.struct(F.col("record_id").alias("id"), "fields").alias("metadata"))
    base = captured.select("record_id", "uri", "type", "refers_to", "declared_digest", F.struct("payload_bytes", "payload_sha1", *more).alias("payload"))
    joined = base.join(requests, "record_id", "left").join(about, "record_id", "left")
    slim = joined.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.struct("payload.payload_bytes", "payload.payload_sha1", F.col("metadata.fields").alias("fields")).alias("original"))
    return joined.join(slim, "refers_to", "left")
