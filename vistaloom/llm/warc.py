"""Revisit resolution in web archives.

Payload headers (digest, length, page_id) are shuffled by digest, each group's
largest page_id becomes the response and the others revisit it, and fresh
archives are written: a response record carries its payload once, a revisit
record only headers that refer to the response. Archives are ordinary
``.warc.gz`` files, one gzip member for each record, written by the tasks
through a table of (path part, bytes) in the shared folder, so any reader of
the store can fetch them, and read back by scanning members. Every record has an id
of its own: a response that stands alone has one made of its page and payload, so that revisits can name it, any
other one of its place in the archives of this run. Where equal rows share the response's page, URL and payload, no
id can stand for them, and revisits name it by URL and date alone.

Scale: only digests and lengths are shuffled to resolve; payloads move once,
with their verdict, straight into an archive. A digest shared by a third of all
pages is a ``max`` with map-side partial aggregation and a skew-splittable join.
An archive holds at most ``ARCHIVE_MB`` before compression and one record more.

Defined results: null html is an empty payload; pages with equal payloads
shorter than ``LEAST_BYTES`` are all responses; repeated page_ids keep a record
each, and if they share a payload as well, all of the largest page_id's are
responses; a null page_id is never a target while another page shares the payload;
an empty table writes no archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.llm.common import read, shared_dir, small_batches
from vistaloom.sources import store

LEAST_BYTES = 0
ARCHIVE_MB = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_url string"


def resolved(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, payload_digest, payload_bytes, refers_to, refers_url, named); refers_to is null for responses.

    ``payload_digest`` is the hexadecimal SHA-1 here; archives state it in base 32. ``named``: of a response,
    whether it is the only row of its page, URL and payload; of a revisit, whether the response that it refers to is.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = pages.withColumn("payload_digest", F.sha1(F.col("html").cast("binary"))).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    first = rows.groupBy("payload_digest", "page_id", "url").agg(F.count("*").alias("n"))
    first = first.groupBy("payload_digest").agg(F.max(F.struct("page_id", "url", "n")).alias("to"), F.sum("n").alias("n"))
    first = first.filter("n > 1").select("payload_digest", "to")
    joined = rows.join(first, "payload_digest", "left")
    is_target = F.col("page_id").eqNullSafe(F.col("to.page_id")) & F.col("url").eqNullSafe(F.col("to.url"))
    revisit = (F.col("payload_bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("to.page_id")) & F.col("to.page_id").isNotNull()
    revisit = F.coalesce(revisit, F.lit(False))
    return joined.select(
        "page_id",
        "url",
        "html",
        "payload_digest",
        "payload_bytes",
        F.when(revisit, F.col("to.page_id")).alias("refers_to"),
        F.when(revisit, F.col("to.url")).alias("refers_url"),
        F.when(F.col("to").isNull(), True).otherwise((F.col("to.n") == 1) & (revisit | is_target)).alias("named"),
    )


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def target(url: str | None) -> str:
    """A URL as a header value: no white space or control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def named_id(page_id, url, digest: str) -> uuid.UUID:
    """The id of a response that is the only row of its page, URL and payload."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest}")


def record(page_id, url, payload: bytes, digest: str, length: int, refers_to, refers_url, named: bool, own: uuid.UUID, date: str) -> bytes:
    """One WARC record with fresh headers; ``own`` is its id if it is not a ``named`` response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    name = named_id(page_id, url, digest) if named and not revisit else own
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Has-Url: {int(url is not None)}",
        f"X-Payload-Length: {length}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        headers[8:8] = [
            f"WARC-Profile: {PROFILE}",
            *([f"WARC-Refers-To: <urn:uuid:{named_id(refers_to, refers_url, digest)}>"] if named else []),
            f"WARC-Refers-To-Target-URI: {target(refers_url)}",
            f"WARC-Refers-To-Date: {date}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(rows: DataFrame, archive_mb: int = ARCHIVE_MB, date: str | None = None) -> str:
    """Resolved rows as archives in the shared folder; returns the folder. All records of a run have its ``date`` (default: now).

    Spark's own committed writer stores each archive as one binary row, so a
    task that is run again, or lost half-way, leaves no archive behind.
    """

    path = f"{shared_dir(rows.sparkSession)}/warc-{uuid.uuid4().hex}"
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, written = io.BytesIO(), 0, 0
        task = TaskContext.get().partitionId()

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"archive": [out.getvalue()]}, pa.schema([("archive", pa.binary())]))

        for b in batches:
            columns = [b.column(k) for k in range(b.num_columns)]
            for i in range(b.num_rows):
                page_id, url, html, digest, length, to, to_url, named = (c[i].as_py() for c in columns)
                own = uuid.uuid5(uuid.NAMESPACE_URL, f"{path}|{task}|{written}")
                written += 1
                raw = record(page_id, url, html.encode(), base32(digest), length, to, to_url, named, own, date)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                out.write(packer.compress(raw) + packer.flush())
                size += len(raw)
                if size >= archive_mb << 20:
                    yield archive()
                    out, size = io.BytesIO(), 0
        if size:
            yield archive()

    small_batches(rows.sparkSession)
    rows.mapInArrow(run, "archive binary").write.option("compression", "uncompressed").parquet(path)
    return path


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive, one record each; a record's cost does not depend on what follows it."""
    view, at = memoryview(data), 0
    while at < len(data):
        d, parts, step = zlib.decompressobj(31), [], 1 << 16
        while not d.eof:
            if at >= len(data):
                raise ValueError("an archive ends within a record")
            chunk = view[at : at + step]
            parts.append(d.decompress(chunk))
            at += len(chunk)
        at -= len(d.unused_data)
        yield b"".join(parts)


def parse(raw: bytes) -> tuple:
    """A record as (page_id, url, payload length, digest, type, refers_to, refers_url, payload)."""
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = block[: int(h["Content-Length"])]
    revisit = h["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    page_id = int(h["X-Page-Id"]) if h["X-Page-Id"] else None
    to = int(h["X-Refers-To-Page-Id"]) if revisit else None
    url = h["WARC-Target-URI"] if h["X-Has-Url"] == "1" else None
    length = int(h["X-Payload-Length"])
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None:
        # the stored payload itself is what the archive vouches for
        length, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return page_id, url, length, digest, h["WARC-Type"], to, h.get("WARC-Refers-To-Target-URI"), payload


def records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the archives in a folder; with ``payloads``, a binary column ``payload`` (null for revisits)."""
    ddl = RECORDS + (", payload binary" if payloads else "")
    width = 8 if payloads else 7
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("refers_url", pa.string()), ("payload", pa.binary())][:width]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0):
                rows = []
                for raw in members(x.as_py()):
                    rows.append(parse(raw)[:width])
                    if len(rows) == (100 if payloads else 5000):
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    return spark.read.schema("archive binary").parquet(path).mapInArrow(run, ddl)


def export(spark: SparkSession, path: str, folder: str) -> int:
    """Writes the archives of a stored folder as ``.warc.gz`` files to a folder of a store, by the tasks that read them; returns how many.

    A file is named by its task and its number there, and is moved into place whole, so a task that runs again writes the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for b in batches:
            for x in b.column(0):
                store.write(f"{folder}/part-{task:06d}-{n:04d}.warc.gz", x.as_py())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]}, pa.schema([("n", pa.int64())]))

    written = spark.read.schema("archive binary").parquet(path).mapInArrow(run, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def unpack(data: bytes) -> list[tuple]:
    """All records of one archive file, by gzip alone."""
    with gzip.open(io.BytesIO(data)) as file:
        whole = file.read()
    found = []
    while whole:
        head, _, rest = whole.partition(b"\r\n\r\n")
        n = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        found.append(parse(head + b"\r\n\r\n" + rest[:n]))
        whole = rest[n + 4 :]
    return found


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the written archives hold of every page."""
    path = write(resolved(read(spark, sf_dir, "pages")))
    return records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLE = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM d)
SELECT page_id, url, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, (k // 4 * 5 + 1)::INT, 5))::INT) >> (15 - k % 4 * 5)::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM m
"""
