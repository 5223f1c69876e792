"""WARC writing and sequential reading.

Writer: one gzip member per record. Of pages with equal payloads (SHA-1 and
length) the one with the largest id becomes a ``response`` record; the others
become ``revisit`` records that name it and carry no payload. Spark's text
writer commits the files, so they go to any store Spark writes to and a lost
task is written again: a member that ends in a zero byte (the top byte of its
length field) is written without it and the zero byte is the line separator;
the rare member that does not (a record of 16 MB or more) is followed by an
empty member, which does. The files are plain concatenated gzip members.

Reader: each file is read front to back with incremental decompression; the
end of a gzip member is the end of a record; the block is framed by
Content-Length; block and payload digests are verified.

Payload hashes and ids alone decide the record types; each payload is shuffled
once, by page id, to the task that writes it. A group of equal payloads is one
row per task after the map-side combine.

Defined results: a null html is an empty payload, and empty payloads count as
equal; rows that repeat the largest id are all responses; a null page id is
written as such and read back null; a null url is left out of the headers; an
empty table gives no records. A file that is cut short, or whose framing is
wrong, raises an error with file and offset; a digest that does not match is
reported in ``digest_ok``.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = b"\r\n"
URN = "urn:page:"
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 16
EMPTY_MEMBER_END = b"\x00"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _record(page_id, url, body: bytes, kind: str, refers_to, length: int, digest: str) -> bytes:
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      b"Content-Length: %d" % length, b"", b""])
    block = http + body
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<{URN}{'' if page_id is None else page_id}>"),
               ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", " ".join(url.split())))
    if kind == "revisit":
        headers += [("WARC-Refers-To", f"<{URN}{refers_to}>"),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(length)),
                ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
                ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + CRLF + CRLF


def _write_batches(batches):
    for batch in batches:
        out = []
        for r in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
            page_id, url, html, refers_to = r
            body = (html or "").encode("utf-8", "surrogatepass")
            digest, kind = base32_sha1(body), "response" if refers_to is None else "revisit"
            member = _member(_record(page_id, url, b"" if refers_to is not None else body, kind, refers_to,
                                     len(body), digest))
            if member[-1]:
                member += _member(b"")
            out.append(member[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def record_types(pages: DataFrame) -> DataFrame:
    """page_id and refers_to (null for responses), one row per distinct page
    id and payload."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    hashed = pages.select("page_id", F.sha1(body).alias("digest"), F.length(body).alias("length")).distinct()
    last = hashed.groupBy("digest", "length").agg(F.max("page_id").alias("last"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return hashed.join(last, ["digest", "length"]).select("page_id", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the pages (page_id, url, html) as archives into the folder."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    keyed = pages.select("page_id", "url", "html", F.sha1(body).alias("digest"))
    kinds = record_types(pages)
    named = (keyed.alias("p").join(kinds.alias("k"), (F.col("p.page_id").eqNullSafe(F.col("k.page_id")))
                                   & (F.col("p.digest") == F.col("k.digest")))
             .select("p.page_id", "url", "html", "refers_to"))
    members = named.mapInArrow(_write_batches, "member binary").select(F.col("member").cast("string"))
    members.write.mode("errorifexists").option("lineSep", "\x00").text(path)


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes


def _members(data: memoryview, name: str) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member, decompressed chunk by chunk."""
    at, end = 0, len(data)
    while at < end:
        start, z, out = at, zlib.decompressobj(31), []
        while not z.eof:
            if at >= end:
                raise ValueError(f"{name}: member at {start} is cut short")
            chunk = data[at:at + CHUNK]
            try:
                out.append(z.decompress(chunk))
            except zlib.error as e:
                raise ValueError(f"{name}: member at {start}: {e}") from e
            at += len(chunk) - len(z.unused_data)
        if out := b"".join(out):
            yield start, out


def read_records(data, name: str = "archive") -> Iterator[Record]:
    """Records of one archive, in order."""
    for offset, raw in _members(memoryview(data), name):
        head, found, rest = raw.partition(CRLF + CRLF)
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        if not found or not lines[0].startswith("WARC/"):
            raise ValueError(f"{name}: no record header at {offset}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(headers.get("content-length", -1))
        if length < 0 or rest[length:] != CRLF + CRLF:
            raise ValueError(f"{name}: wrong framing at {offset}")
        yield Record(offset, headers, rest[:length])


def _page(value: str | None) -> int | None:
    number = (value or "").strip("<>").removeprefix(URN)
    return int(number) if number else None


def _digest(value: str | None) -> str | None:
    return value.rpartition(":")[2] if value else None


READ_SCHEMA = ("path string, offset long, page_id long, url string, record_type string, refers_to long, "
               "payload_bytes long, payload_digest string, digest_ok boolean, payload string")


def _read_batches(batches):
    names = [f.split()[0] for f in READ_SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(),
             pa.bool_(), pa.string()]

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            path, rows, held = path.as_py(), [], 0
            for r in read_records(content.as_buffer(), path):
                kind, h = r.headers.get("warc-type"), r.headers
                payload = r.block
                if h.get("content-type", "").startswith("application/http"):
                    payload = r.block.partition(CRLF + CRLF)[2]
                digest, length = _digest(h.get("warc-payload-digest")), len(payload)
                ok = _digest(h.get("warc-block-digest")) in (None, base32_sha1(r.block))
                if kind == "revisit":
                    length, payload = int(h.get("warc-payload-length", 0)), None
                else:
                    ok = ok and digest in (None, base32_sha1(payload))
                rows.append((path, r.offset, _page(h.get("warc-record-id")), h.get("warc-target-uri"), kind,
                             _page(h.get("warc-refers-to")), length, digest, ok,
                             None if payload is None else payload.decode("utf-8", "replace")))
                held += len(r.block)
                if held > 4_000_000:
                    yield packed(rows)
                    rows, held = [], 0
            if rows:
                yield packed(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder, one row each (READ_SCHEMA).
    A file is read by one task; the writer's files are those of its tasks."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read_batches, READ_SCHEMA)
