"""Legacy ARC archives: writing, reading, and conversion to WARC.

Method. An ARC file starts with a ``filedesc`` record whose body names the
version and lists the fields of the URL-record lines; version 1 has five fields,
version 2 ten. Records are cut by the length that their header line declares.
The converter turns each into a WARC record and synthesises what ARC lacks:
record ids (UUID from file name and offset), ISO dates from 14-digit stamps, the
record type (``warcinfo``, ``response``, ``resource``, ``revisit``) and SHA-1
digests of block and payload.

Records with equal payloads of at least ``min_revisit`` bytes keep one response
(the largest key); the others become revisits without payload, which keep their
HTTP headers. Which record wins is settled on digests alone, so no payload is
shuffled: the few revisit decisions are joined to the archive files by name.

Archives are written and read by Spark (text writer, ``binaryFile``), so any
store that Spark reaches will do. Archives are gzip files; a reader holds one
compressed file and one record at a time, and ``RECORDS_PER_FILE`` bounds files.

Defined results: a null html is an empty payload; a null url is written as ``-``
and white space in urls is percent-encoded; a null key has no ``X-Page-Id``
header and reads back as null; of equal payloads with equal keys the last record
id wins and the rest revisit it; extra columns are dropped; an empty table gives
archives without page records and an empty result. A record whose declared
length does not end at a record boundary raises ``ValueError``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, materialize, scratch_path
from .common import slices

RECORDS_PER_FILE = 20_000
MIN_REVISIT = 1000
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LINES = T.StructType([T.StructField("value", T.BinaryType())])


# ---- writing ARC ----------------------------------------------------------
def _escaped(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f\x85\xa0  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "-"


def arc_header(version: int, date: str) -> bytes:
    """The filedesc record of an ARC file, without the newline that ends it."""
    body = f"{version} 0 corpus\n{ARC_FIELDS[version]}\n".encode()
    extra = " 200 - - 0 -" if version == 2 else ""
    return f"filedesc://pages.arc 0.0.0.0 {date} text/plain{extra} {len(body)}\n".encode() + body


def arc_record(version: int, key: int | None, url: str | None, html: bytes, date: str) -> bytes:
    """One page as an ARC record with an HTTP response, without its last newline."""
    page = "" if key is None else f"X-Page-Id: {key}\r\n"
    doc = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(html)}\r\n{page}\r\n".encode() + html
    extra = " 200 - - 0 pages.arc" if version == 2 else ""
    return f"{_escaped(url)} 0.0.0.0 {date} text/html{extra} {len(doc)}\n".encode() + doc


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = "20240101000000", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write pages as ARC files, version 1 and 2 by turns of the partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        version = 1 + TaskContext.get().partitionId() % 2
        n = 0
        for whole in batches:
            for batch in slices(whole, 500, text=2):
                out = []
                for k, u, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                    if n % (records_per_file - 1) == 0:
                        out.append(arc_header(version, date))
                    n += 1
                    out.append(arc_record(version, k, u, h or b"", date))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    lines = pages.selectExpr(f"CAST(`{key}` AS BIGINT) AS k", f"CAST(`{url}` AS STRING) AS u", f"CAST(`{html}` AS STRING) AS h").mapInArrow(run, _LINES)
    lines.selectExpr("CAST(value AS STRING) AS value").write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


# ---- reading ARC ----------------------------------------------------------
def opened(content: bytes) -> io.BufferedReader:
    """A stream over an archive's content, compressed or not."""
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else io.BufferedReader(raw)


def arc_records(content: bytes) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, header fields, body) of every record of an ARC file."""
    f, fields, at = opened(content), ARC_FIELDS[1].split(), 0
    while line := f.readline():
        if not line.strip():
            at += len(line)
            continue
        values = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        names = fields
        if values[0].startswith("filedesc://"):
            names = ARC_FIELDS[2 if len(values) == 10 else 1].split()
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"bad ARC record line at {at}")
        head = dict(zip(names, values, strict=True))
        body = f.read(size := int(values[-1]))
        if len(body) != size or f.peek(1)[:1] not in (b"", b"\n", b"\r"):
            raise ValueError(f"declared length of the ARC record at {at} is wrong")
        if values[0].startswith("filedesc://"):
            version, definition = body.decode().split("\n")[:2]
            head["version"], fields = int(version.split(" ")[0]), definition.split()
        yield at, head, body
        at += len(line) + size


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """(HTTP headers with their blank line, payload); no HTTP: (empty, body)."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    head, sep, payload = body.partition(b"\r\n\r\n")
    return head + sep, payload


def http_value(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace") if found else None


def record_id(file: str, offset: int) -> str:
    digest = hashlib.sha1(f"{file.rsplit('/', 1)[-1]}:{offset}".encode()).digest()
    return f"urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}"


def iso_date(stamp: str, default: str = "19960101000000") -> str:
    """WARC date of an ARC stamp; missing digits are filled up."""
    digits = stamp if stamp.isdigit() and 4 <= len(stamp) <= 14 else default
    d = digits + default[len(digits) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


_INDEX = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("key", T.LongType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("digest", T.StringType()),
])


def arc_index(files: DataFrame, min_bytes: int) -> DataFrame:
    """Where each payload of at least ``min_bytes`` lies, with its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, rows = batch.column(0)[i].as_py(), []
                for at, head, body in arc_records(batch.column(1)[i].as_py()):
                    http, payload = split_http(body)
                    if http and len(payload) >= min_bytes:
                        key = http_value(http, b"X-Page-Id")
                        rows.append((file, at, key and int(key), record_id(file, at), head["URL"], hashlib.sha1(payload).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], names=_INDEX.names)

    return files.select("path", "content").mapInArrow(run, _INDEX)


# ---- writing WARC ---------------------------------------------------------
def warc_record(kind: str, rid: str, date: str, block: bytes, fields: list[tuple[str, str]]) -> bytes:
    """A WARC record without the two line ends that close it."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{rid}>"), ("WARC-Date", date), *fields, ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block


def convert_record(file: str, at: int, head: dict, body: bytes, refers: tuple[str, str] | None) -> bytes:
    """The WARC record that stands for one ARC record."""
    rid, date = record_id(file, at), iso_date(head["Archive-date"])
    if head["URL"].startswith("filedesc://"):
        info = f"software: wordspace\r\nformat: WARC File Format 1.1\r\nconverted-from: ARC version {head['version']}\r\n".encode()
        return warc_record("warcinfo", rid, date, info, [("WARC-Filename", file.rsplit("/", 1)[-1]), ("Content-Type", "application/warc-fields")])
    http, payload = split_http(body)
    fields = [("WARC-Target-URI", head["URL"]), ("WARC-IP-Address", head["IP-address"]), ("WARC-Payload-Digest", _base32(hashlib.sha1(payload).digest()))]
    if not http:
        return warc_record("resource", rid, date, body, [*fields, ("Content-Type", head["Content-type"])])
    fields.append(("Content-Type", "application/http; msgtype=response"))
    if refers is None:
        return warc_record("response", rid, date, body, fields)
    return warc_record("revisit", rid, date, http, [*fields, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers[0]}>"), ("WARC-Refers-To-Target-URI", refers[1])])


def arc_to_warc(spark: SparkSession, arc: str, warc: str, min_revisit: int = MIN_REVISIT) -> None:
    """Convert the ARC files of a folder to WARC files in another."""
    files = spark.read.format("binaryFile").load(arc).select("path", "content")
    index = materialize(arc_index(files, min_revisit))
    winners = index.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(F.coalesce("key", F.lit(-(1 << 63))).alias("key"), "record_id", "uri")).alias("best")).filter("n > 1").select("digest", "best")
    revisits = index.join(winners, "digest").filter("record_id <> best.record_id")
    # at most the records of one file in a list; written, so that its size decides about a broadcast
    by_file = revisits.groupBy("file").agg(F.collect_list(F.struct("offset", F.col("best.record_id").alias("rid"), F.col("best.uri").alias("uri"))).alias("refers"))
    decisions = scratch_path(spark, "revisits")
    by_file.write.parquet(decisions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, out, held = batch.column(0)[i].as_py(), [], 0
                refers = {r["offset"]: (r["rid"], r["uri"]) for r in batch.column(2)[i].as_py() or ()}
                for at, head, body in arc_records(batch.column(1)[i].as_py()):
                    out.append(convert_record(file, at, head, body, refers.get(at)))
                    held += len(out[-1])
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, held = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    joined = files.join(spark.read.schema(by_file.schema).parquet(decisions).withColumnRenamed("file", "path"), "path", "left").select("path", "content", "refers")
    joined.mapInArrow(run, _LINES).selectExpr("CAST(value AS STRING) AS value").write.option("lineSep", WARC_END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(warc)
    drop_path(spark, decisions)


# ---- reading WARC ---------------------------------------------------------
def warc_records(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header fields by lower-case name, block) of every record."""
    f = opened(content)
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should start")
        head: dict[str, str] = {}
        while (line := f.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        block = f.read(size := int(head["content-length"]))
        if len(block) != size:
            raise ValueError("a WARC record is cut off")
        yield head, block


RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("refers_id", T.StringType()),
    T.StructField("uri", T.StringType()),
])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response and revisit records of a folder of WARC files. The digest of a
    response is computed anew and must be the one in its header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for head, block in warc_records(batch.column(0)[i].as_py()):
                    kind = head["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, payload = split_http(block)
                    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
                    if kind == "response" and hashlib.sha1(payload).digest() != digest:
                        raise ValueError(f"payload digest of {head['warc-record-id']} is wrong")
                    size = len(payload) if kind == "response" else int(http_value(http, b"Content-Length") or 0)
                    key = http_value(http, b"X-Page-Id")
                    rows.append((key and int(key), size, digest.hex(), kind, head["warc-record-id"].strip("<>"), head.get("warc-refers-to", "").strip("<>") or None, head.get("warc-target-uri")))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, (pa.int64(), pa.int64(), *[pa.string()] * 5), strict=True)], names=RECORDS.names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORDS)


def archive_pages(spark: SparkSession, pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """pages -> ARC files -> WARC files -> one row per page as read back."""
    base = scratch_path(spark, "archive")
    write_arc(pages, f"{base}/arc")
    arc_to_warc(spark, f"{base}/arc", f"{base}/warc", min_revisit)
    drop_path(spark, f"{base}/arc")
    records = materialize(read_warc(spark, f"{base}/warc"))
    out = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    targets = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    kept = records.filter("record_type = 'response'").select(*out, F.lit(None).cast("long").alias("refers_to"))
    return kept.unionByName(records.filter("record_type = 'revisit'").join(targets, "refers_id", "left").select(*out, "refers_to"))
