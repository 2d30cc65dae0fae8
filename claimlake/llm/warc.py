"""Legacy web archives: ARC files of versions 1 and 2 become WARC records.

An ARC file opens with a version block whose second line gives the version and whose
third names the fields of every following header line: five in version 1, ten in
version 2. Each header line is split by those fields; its last number declares how many
bytes of content follow. From a record the converter makes a WARC record of the same
content: a record id (a UUID of address, date and content digest, so that repeated
conversions agree), the 14-digit date as ISO 8601, ``warcinfo`` for the version block,
``response`` for HTTP content and ``resource`` for the rest, and SHA-1 digests (base32)
of block and payload.

Records with equal payloads are stored once: the one of the smallest page id stays a
response, the others become ``revisit`` records that keep their HTTP head and name the
response they refer to. Archives are written by Spark's text writer, one record a
"line" (records end with a blank line), gzipped, at most RECORDS_PER_FILE to a file, and
read back file by file as streams.

A null html is an empty payload; a null address becomes ``urn:page:<id>``, white space
in addresses is percent-encoded. Rows that repeat the smallest page id of a payload are
all responses. An empty table gives no records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import FILTER_BITS, id_filter, in_filter, shared_path, stage, table, tidy

RECORDS_PER_FILE = 4000
#: Pages that go into one ARC file of the query.
PAGES_PER_ARC = 128

# The header fields of the two ARC versions, as their version blocks
# name them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UUID_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:archive-conversion")


@dataclass
class ArcRecord:
    version: int
    fields: dict[str, str]
    content: bytes


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def write_arc(records: list[tuple[str, str, str, bytes]], version: int, name: str = "archive.arc", date: str = "20000101000000") -> bytes:
    """An ARC file of (url, date, content type, content)."""
    about = f"{version} 0 public\n{ARC_FIELDS[version]}\n".encode()

    def head(url: str, when: str, kind: str, at: int, content: bytes) -> bytes:
        if version == 1:
            return f"{url} 0.0.0.0 {when} {kind} {len(content)}\n".encode()
        return f"{url} 0.0.0.0 {when} {kind} 200 {hashlib.md5(content).hexdigest()} - {at} {name} {len(content)}\n".encode()

    parts = [head(f"filedesc://{name}", date, "text/plain", 0, about), about]
    at = sum(map(len, parts)) + 1
    for url, when, kind, content in records:
        h = head(url, when, kind, at, content)
        parts += [b"\n", h, content]
        at += 1 + len(h) + len(content)
    return b"".join(parts)


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, version block first, by declared lengths."""
    at, fields, version = 0, ARC_FIELDS[1].split(), 1
    first = True
    while True:
        while at < len(data) and data[at] in b"\r\n":
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"ARC header line at {at} has no end")
        values = data[at:end].decode("utf-8").rstrip("\r").split(" ")
        if first and len(values) != len(fields):
            fields = ARC_FIELDS[2].split()
        if len(values) != len(fields) or not values[-1].isdigit():
            raise ValueError(f"ARC header line at {at} does not have the fields {fields}")
        size = int(values[-1])
        content = data[end + 1 : end + 1 + size]
        if len(content) != size:
            raise ValueError(f"ARC record at {at} is shorter than declared")
        own = dict(zip((f.lower() for f in fields), values, strict=True))
        if first:
            lines = content.decode("utf-8").splitlines()
            version = int(lines[0].split(" ")[0])
            if len(lines) > 1 and lines[1].strip():
                fields = lines[1].split()
            first = False
        yield ArcRecord(version, own, content)
        at = end + 1 + size


def iso_date(date: str) -> str:
    """A 14-digit date (shorter ones are filled up) as ISO 8601."""
    d = (date + "00000101000000"[len(date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _http_parts(content: bytes) -> tuple[bytes, bytes]:
    head, gap, body = content.partition(b"\r\n\r\n")
    if not gap:
        head, gap, body = content.partition(b"\n\n")
    return head + gap, body


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes

    def text(self) -> str:
        """The record without the blank line that ends it."""
        head = "".join(f"{k}: {v}\r\n" for k, v in self.headers.items())
        return f"WARC/1.1\r\n{head}\r\n{self.block.decode('utf-8')}"


def to_warc(r: ArcRecord) -> WarcRecord:
    url, date = r.fields["url"], r.fields["archive-date"]
    kind = r.fields["content-type"]
    http = r.content[:5] == b"HTTP/"
    payload = _http_parts(r.content)[1] if http else r.content
    block = sha1_base32(r.content)
    headers = {
        "WARC-Type": "warcinfo" if url.startswith("filedesc:") else "response" if http else "resource",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_UUID_SPACE, f'{url} {date} {block}')}>",
        "WARC-Date": iso_date(date),
    }
    if headers["WARC-Type"] == "warcinfo":
        headers["WARC-Filename"] = url.removeprefix("filedesc://")
    else:
        headers |= {"WARC-Target-URI": url, "WARC-IP-Address": r.fields["ip-address"], "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}"}
    headers |= {
        "WARC-Block-Digest": f"sha1:{block}",
        "Content-Type": "application/http; msgtype=response" if http else kind,
        "Content-Length": str(len(r.content)),
    }
    return WarcRecord(headers, r.content)


def revisit(r: WarcRecord, refers_to: str, uri: str, date: str) -> WarcRecord:
    """The record without its payload, pointing to the one that has it."""
    block = _http_parts(r.block)[0]
    headers = dict(r.headers) | {
        "WARC-Type": "revisit",
        "WARC-Profile": _PROFILE,
        "WARC-Refers-To": refers_to,
        "WARC-Refers-To-Target-URI": uri,
        "WARC-Refers-To-Date": date,
        "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
        "Content-Length": str(len(block)),
    }
    return WarcRecord(headers, block)


def read_warc(stream: io.BufferedIOBase) -> Iterator[WarcRecord]:
    """The records of a WARC stream, one in memory at a time."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8").partition(":")
            headers[k.strip()] = v.strip()
        size = int(headers["Content-Length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is shorter than declared")
        yield WarcRecord(headers, block)


# --- Spark jobs ---------------------------------------------------------------------

def page_arcs(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(archive): ARC files of the pages, versions 1 and 2 by turns. The page id travels in
    an HTTP header, as ARC has no field for it."""

    def run(batches):
        turn = 0
        for batch in batches:
            for k in range(0, batch.num_rows, PAGES_PER_ARC):
                part = batch.slice(k, PAGES_PER_ARC)
                records = []
                for i, u, t in zip(*[part.column(c).to_pylist() for c in range(3)], strict=True):
                    body = (t or "").encode("utf-8")
                    u = "".join(f"%{ord(c):02X}" if c.isspace() and c < "\x80" else "%C2%A0" if c.isspace() else c for c in u) if u else f"urn:page:{i}"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nX-Page-Id: {'' if i is None else i}\r\nContent-Length: {len(body)}\r\n\r\n"
                    records.append((u, f"2000{(i or 0) % 12 + 1:02d}01000000", "text/html", head.encode() + body))
                turn += 1
                yield pa.RecordBatch.from_arrays([pa.array([write_arc(records, 1 + turn % 2)], pa.binary())], ["archive"])

    return pages.select(F.col(f"`{id}`").cast("long").alias("i"), F.col(f"`{url}`").cast("string").alias("u"), F.col(f"`{html}`").cast("string").alias("h")).mapInArrow(tidy(run), "archive binary")


def _page_id(block: bytes) -> int | None:
    head = _http_parts(block)[0]
    at = head.find(b"X-Page-Id: ")
    value = head[at + 11 : head.find(b"\r\n", at)] if at >= 0 else b""
    return int(value) if value else None


def _slot(record_id: str) -> int:
    """The bit of a record id in a filter: the id is a hash already."""
    return int(record_id[10:17], 16) % (1 << FILTER_BITS)


def converted(archives: DataFrame, bits: bytes | None = None, inside: bool = True) -> DataFrame:
    """WARC records of the ARC files in column ``archive``: page_id, record_id, uri, date,
    digest and size of the payload; and with a filter of record ids (``bits``) the text
    of the records that may be in it, or if not ``inside`` of those that are not."""
    with_text = bits is not None

    def run(batches):
        held = np.frombuffer(bits or b"", np.uint8)
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for r in read_arc(data.as_py()):
                    w = to_warc(r)
                    if w.headers["WARC-Type"] != "warcinfo":
                        h = w.headers
                        if with_text and bool(in_filter(held, np.int64(_slot(h["WARC-Record-ID"])))) != inside:
                            continue
                        size = len(_http_parts(w.block)[1]) if h["WARC-Type"] == "response" else len(w.block)
                        rows.append((_page_id(w.block), h["WARC-Record-ID"], h["WARC-Target-URI"], h["WARC-Date"], h["WARC-Payload-Digest"], size, w.text() if with_text else None))
                cols = list(zip(*rows, strict=True)) or [[]] * 7
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
                out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["page_id", "record_id", "uri", "date", "digest", "size", "record"])
                yield out if with_text else out.select(list(range(6)))

    return archives.select("archive").mapInArrow(tidy(run), "page_id long, record_id string, uri string, date string, digest string, size long" + ", record string" * with_text)


def _as_revisits(rows: DataFrame) -> DataFrame:
    """(record): records with a first_* response become revisits, others stay."""

    def run(batches):
        for batch in batches:
            out = []
            for record, rid, uri, date in zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True):
                if rid is not None:
                    record = revisit(next(read_warc(io.BytesIO(record.encode("utf-8")))), rid, uri, date).text()
                out.append(record)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])

    return rows.select("record", "first_id", "first_uri", "first_date").mapInArrow(tidy(run), "record string")


def write_warcs(spark: SparkSession, archives: DataFrame, path: str, least: int = 0) -> None:
    """Convert ARC files (column ``archive``) and write WARC archives to ``path``. Payloads
    of at least ``least`` bytes are stored once."""
    known = stage(spark, converted(archives), "digests")
    first = known.where(F.col("size") >= least).groupBy("digest", "size").agg(F.min(F.struct("page_id", "record_id", "uri", "date")).alias("f"), F.count("*").alias("n")).where("n > 1")
    again = known.join(first, ["digest", "size"]).where("NOT (page_id <=> f.page_id)")
    again = stage(spark, again.select("record_id", F.col("f.record_id").alias("first_id"), F.col("f.uri").alias("first_uri"), F.col("f.date").alias("first_date")).distinct(), "revisits")
    # the bit that _slot reads
    bits = id_filter(again, F.conv(F.substring("record_id", 11, 7), 16, 10).cast("long") % (1 << FILTER_BITS))
    plain = converted(archives, bits, inside=False).select("record")
    others = converted(archives, bits).join(again, "record_id", "left")
    plain.union(_as_revisits(others)).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives in ``path``: page_id, record_id, record_type, digest and
    size (from the payload where the record has it, else as stated or null) and
    refers_to, the id of the record referred to."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for w in read_warc(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data.as_py())), 1 << 16)):
                    h = w.headers
                    if h["WARC-Block-Digest"] != f"sha1:{sha1_base32(w.block)}":
                        raise ValueError(f"the block of {h['WARC-Record-ID']} does not have its digest")
                    if h["WARC-Type"] == "revisit":
                        rows.append((_page_id(w.block), h["WARC-Record-ID"], "revisit", h["WARC-Payload-Digest"].removeprefix("sha1:"), None, h["WARC-Refers-To"]))
                    else:
                        payload = _http_parts(w.block)[1] if h["WARC-Type"] == "response" else w.block
                        rows.append((_page_id(w.block), h["WARC-Record-ID"], h["WARC-Type"], sha1_base32(payload), len(payload), None))
                cols = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["page_id", "record_id", "record_type", "digest", "size", "refers_to"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(tidy(run), "page_id long, record_id string, record_type string, digest string, size long, refers_to string")


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warcs(spark, page_arcs(table(spark, sf_dir, "pages")), path)
    back = stage(spark, read_warcs(spark, path), "read")
    target = back.where("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("target"), F.col("size").alias("target_size")).dropDuplicates(["refers_to"])
    out = back.join(target, "refers_to", "left")
    return out.select("page_id", F.coalesce("size", "target_size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", F.col("target").alias("refers_to"))


OP4_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, n, translate(
    to_base(CAST('0x' || hex[1:10] AS BIGINT), 32, 8) || to_base(CAST('0x' || hex[11:20] AS BIGINT), 32, 8) ||
    to_base(CAST('0x' || hex[21:30] AS BIGINT), 32, 8) || to_base(CAST('0x' || hex[31:40] AS BIGINT), 32, 8),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS digest
  FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY n, digest) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
