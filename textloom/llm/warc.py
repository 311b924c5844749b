"""WARC: archives with revisit records, segmented records and chunked transfer framing, written and read back.

Writing: payload digests are counted in the JVM, and the least key of each digest is its response, so equal payloads of any number
meet only as combined minima. Records become lines of Spark's text writer, whose separator is the blank line that ends a
record, so archives go through the cluster's own file system and committer; a lost executor's part is written anew.
A block longer than ``segment_bytes`` is cut, at character borders, into a record and its continuations.

Reading: files are parsed once, record by record by their Content-Length, whoever wrote them: records of any type and identifier, with or without
target, digest or HTTP message. Segments are grouped by the identifier of their origin,
a group being the segments of one record, put in order, and checked against the total length; chunked framing is decoded and the
payload's digest compared with the header's. The page's key, of whatever type, travels in the extension fields ``X-Page-Key`` and ``X-Refers-To-Key``.

Defined results: a null payload is empty; a null url is an empty target; line breaks in a url or key are percent-encoded; rows of
the same key are records of their own, and if theirs is the least key of a payload each of them is a response; a row with a null key is a response
that no other refers to; an empty table gives no archive records; other columns of the input are ignored. A record that fails a check keeps its
row, with what is wrong in ``error`` and no payload; what follows a broken frame in a file is one such row.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import shared_dir, written

CRLF = "\r\n"
HTTP_RESPONSE = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
HTTP_REVISIT = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http"
RECORDS = "record_id string, origin_id string, key string, url string, type string, segment int, total long, digest string, refers_to string, content_type string, block binary, error string"
PAYLOADS = "record_id string, key string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, n_segments int, payload binary, error string"


def record_id() -> str:
    """An identifier that no other record has."""
    return f"<urn:uuid:{uuid.uuid4()}>"


def _field(value: object) -> str:
    """A header field's value: line breaks are percent-encoded."""
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def _cuts(text: str, most: int) -> list[str]:
    """``text`` in pieces of at most ``most`` UTF-8 bytes (or one character); no piece for no text."""
    step = max(1, most // 4) if not text.isascii() else most
    return [text[i : i + step] for i in range(0, len(text), step)]


def chunked(text: str, chunk_bytes: int) -> str:
    parts = [f"{len(c.encode()):x}{CRLF}{c}{CRLF}" for c in _cuts(text, chunk_bytes)]
    return "".join(parts) + f"0{CRLF}{CRLF}"


def unchunked(body: bytes) -> bytes:
    """Decode chunked transfer framing; ``ValueError`` if it is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size line is missing")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is not ended")
        out.append(body[at : at + size])
        at += size + 2


def records(key: str | None, url: str | None, payload: str | None, refers_to: str | None, segment_bytes: int, chunk_bytes: int) -> Iterator[str]:
    """The records of one page, each without the blank line that ends it."""
    text = payload or ""
    raw = text.encode("utf-8", "replace")
    digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
    own, common = record_id(), f"WARC-Date: 2000-01-01T00:00:00Z{CRLF}WARC-Target-URI: {_field(url or '')}{CRLF}WARC-Payload-Digest: sha1:{digest}{CRLF}"
    if key is not None:
        common += f"X-Page-Key: {_field(key)}{CRLF}"
    if refers_to is not None:
        block = HTTP_REVISIT.format(len(raw))
        yield (
            f"WARC/1.1{CRLF}WARC-Type: revisit{CRLF}WARC-Record-ID: {own}{CRLF}{common}WARC-Profile: {PROFILE}{CRLF}X-Refers-To-Key: {_field(refers_to)}{CRLF}"
            f"Content-Type: {HTTP}; msgtype=response{CRLF}Content-Length: {len(block)}{CRLF}{CRLF}{block}"
        )
        return
    message = HTTP_RESPONSE + chunked(text, chunk_bytes)
    parts = _cuts(message, segment_bytes)
    total = len(message.encode("utf-8", "replace"))
    for n, part in enumerate(parts, 1):
        head = f"WARC-Type: response{CRLF}WARC-Record-ID: {own}{CRLF}{common}" if n == 1 else f"WARC-Type: continuation{CRLF}WARC-Record-ID: {record_id()}{CRLF}WARC-Segment-Origin-ID: {own}{CRLF}{common}"
        if len(parts) > 1:
            head += f"WARC-Segment-Number: {n}{CRLF}" + (f"WARC-Segment-Total-Length: {total}{CRLF}" if n == len(parts) else "")
        yield f"WARC/1.1{CRLF}{head}Content-Type: {HTTP}; msgtype=response{CRLF}Content-Length: {len(part.encode('utf-8', 'replace'))}{CRLF}{CRLF}{part}"


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", min_revisit_bytes: int = 0, segment_bytes: int = 1 << 14, chunk_bytes: int = 1 << 12, records_per_file: int = 4000) -> None:
    """Write a record for each row, or several if it is segmented, into gzip-compressed archives under ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes``, those with the least key (in the order of its type) are responses; the others revisit it.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    marked = rows.select("key", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size"))
    least = marked.groupBy("digest").agg(F.min("key").alias("least"))
    others = marked.filter(F.col("size") >= min_revisit_bytes).join(least, "digest").filter("key > least").select("key", "digest", "least").distinct()
    joined = rows.withColumn("digest", F.sha1("payload")).join(others, ["key", "digest"], "left").select(F.col("key").cast("string"), "url", "payload", F.col("least").cast("string"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for lo in range(0, batch.num_rows, 500):
                some = zip(*(c.slice(lo, 500).to_pylist() for c in columns), strict=True)
                made = [r for k, u, p, least_key in some for r in records(k, u, p, least_key, segment_bytes, chunk_bytes)]
                yield pa.RecordBatch.from_pydict({"value": pa.array(made, pa.string())})

    joined.mapInArrow(lines, "value string").write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parsed(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of an open archive; ``ValueError`` where its frame is broken."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head.get("content-length", "-1"))
        if size < 0:
            raise ValueError(f"{head.get('warc-record-id')} has no length")
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{head.get('warc-record-id')} is cut short")
        yield head, block


def _payload(kind: str | None, content_type: str | None, digest: str | None, block: bytes) -> tuple[int, bytes | None]:
    """Length of the payload, and the payload itself if the record has it; ``ValueError`` if it fails a check."""
    body, head = block, b""
    if (content_type or "").lower().startswith(HTTP):
        head, _, body = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        lengths = [int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        return (lengths[0] if lengths else len(body)), None
    body = unchunked(body) if any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(b"\r\n")) else body
    if digest and digest.lower().startswith("sha1:") and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest[5:].upper():
        raise ValueError("payload does not match its digest")
    return len(body), body


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, segments put together: record_id, key, url, record_type, refers_to, payload_digest (without ``sha1:``), payload_bytes, n_segments, payload (null for revisits), error."""
    names = [f.split(" ")[0] for f in RECORDS.split(", ")]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def row(head: dict[str, str], block: bytes) -> tuple:
        own, total, segment = head.get("warc-record-id"), head.get("warc-segment-total-length"), head.get("warc-segment-number")
        return (own, head.get("warc-segment-origin-id", own), head.get("x-page-key"), head.get("warc-target-uri"), head.get("warc-type"), int(segment or 0), int(total) if total else None, head.get("warc-payload-digest"), head.get("x-refers-to-key"), head.get("content-type"), block, None)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                stream = io.BytesIO(content.as_buffer())
                try:
                    for head, block in parsed(gzip.GzipFile(fileobj=stream) if content.as_buffer()[:2] == b"\x1f\x8b" else stream):
                        rows.append(row(head, block))
                        if (size := size + len(block)) > 1 << 22:
                            yield out(rows)
                            rows, size = [], 0
                except (ValueError, EOFError, OSError, zlib.error) as e:
                    rows.append((*[None] * 5, 0, *[None] * 5, f"{type(e).__name__}: {e}"))
                if rows:
                    yield out(rows)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 6 + [pa.int64(), pa.int32(), pa.binary(), pa.string()]
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = []
                for record, key, url, kind, refers, digest, content_type, parts, error in zip(*(c.slice(lo, 500).to_pylist() for c in batch.columns), strict=True):
                    size = payload = None
                    if error is None:
                        try:
                            size, payload = _payload(kind, content_type, digest, b"".join(parts))
                        except (ValueError, IndexError) as e:
                            error = f"{type(e).__name__}: {e}"
                    rows.append((record, key, url, kind, refers, (digest or "").removeprefix("sha1:") or None, size, len(parts), payload, error))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split(" ")[0] for f in PAYLOADS.split(", ")])

    files = spark.read.format("binaryFile").load(path).select("content")
    found = written(files.mapInArrow(parse, RECORDS), "records", "zstd")
    columns = ["record_id", "key", "url", "type", "refers_to", "digest", "content_type"]
    single = found.filter("segment = 0").select(*columns, F.array("block").alias("parts"), "error")
    # The segments of one record; its first one has the headers of the whole.
    first = F.min_by(F.struct(*columns), "segment").alias("first")
    groups = found.filter("segment > 0").groupBy("origin_id").agg(first, F.sort_array(F.collect_list(F.struct("segment", "total", "block"))).alias("s"))
    last = F.element_at("s", -1)
    length = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x["block"]))
    whole = (F.transform("s", lambda x: x["segment"]) == F.sequence(F.lit(1), F.size("s"))) & (last["total"] == length)
    segmented = groups.select("first.*", F.transform("s", lambda x: x["block"]).alias("parts"), F.when(~F.coalesce(whole, F.lit(False)), F.concat(F.lit("segments do not make up "), F.coalesce("origin_id", F.lit("a record")))).alias("error"))
    return single.unionByName(segmented).mapInArrow(decode, PAYLOADS)


def round_trip(pages: DataFrame, key: str = "page_id", min_revisit_bytes: int = 0, **how) -> DataFrame:
    """Write the pages into archives in the shared folder and read these back, with keys of the pages' type. A record that fails a check ends the query: these archives are its own."""
    path = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, key, min_revisit_bytes=min_revisit_bytes, **how)
    kind = pages.schema[key].dataType
    back = read_archives(pages.sparkSession, path)
    # Its records are a table by now, so the archives need no more disk.
    sc = pages.sparkSession.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col("record_type"))
    return back.withColumns({"record_type": sound, "key": F.col("key").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


#: Base32 in SQL: 40 groups of five bits of the digest's 160.
ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h, min(page_id) OVER (PARTITION BY sha1(b)) AS first FROM p),
g AS (SELECT page_id, n, first, [CAST(concat('0x', h[k * 5 + 1 : k * 5 + 5]) AS BIGINT) for k in range(8)] AS v FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31 AS INTEGER) + 1, 1) for k in range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM g
"""
