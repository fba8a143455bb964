"""WARC 1.1 archives: one gzip member per record, written and read by tasks.

A page is a ``response`` record (an HTTP message with the whole payload) or,
when a page with an equal payload is kept, a ``revisit`` record that refers to
it.  The reader goes through an archive sequentially: it inflates one member
after another in small pieces, frames each record by its Content-Length and
verifies block and payload digests, without holding a record in memory.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import Scratch, slices, utf8

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
CHUNK = 1 << 16
#: bytes after which a task begins another archive
ROLL = 1 << 30
#: longest record or HTTP header block the reader accepts
MAX_HEADER = 1 << 20


def digest_of(h) -> str:
    """Bare upper-case base32 of a SHA-1."""
    return base64.b32encode(h.digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def render(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record; ``refers_to`` makes it a revisit of the page of that id."""
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = hashlib.sha1(http)
    if not revisit:
        block.update(payload)
    target = urllib.parse.quote(url, safe="/:?#[]@!$&'()*+,;=%~") if url else f"urn:page:{page_id}"
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", "sha1:" + digest),
            ("WARC-Block-Digest", "sha1:" + digest_of(block)), ("Content-Type", "application/http;msgtype=response"),
            ("X-Page-ID", "" if page_id is None else str(page_id))]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    head.append(("Content-Length", str(len(http) + (0 if revisit else len(payload)))))
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return b"".join([lines.encode(), http, b"" if revisit else payload, b"\r\n\r\n"])


def member(record: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload_bytes: int
    payload_digest: str
    payload: bytes | None = field(default=None, repr=False)


class _Member:
    """Bytes of the next gzip member of a stream, inflated piece by piece."""

    def __init__(self, source: IO[bytes], pending: bytes):
        self.source, self.pending, self.inflate, self.ready = source, pending, zlib.decompressobj(31), b""

    def more(self) -> bytes:
        """The next piece, empty at the end of the member."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.pending or self.source.read(CHUNK)
            if not self.inflate.unconsumed_tail:
                self.pending = b""
            if not data:
                raise ValueError("the archive ends within a record")
            out = self.inflate.decompress(data, CHUNK)
            if out:
                return out
        return b""

    def until(self, mark: bytes) -> bytes:
        """Everything up to and including ``mark``."""
        while (at := self.ready.find(mark)) < 0:
            piece = self.more()
            if not piece or len(self.ready) > MAX_HEADER:
                raise ValueError(f"{mark!r} is missing in a record")
            self.ready += piece
        out, self.ready = self.ready[:at + len(mark)], self.ready[at + len(mark):]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes, in pieces."""
        while n:
            if not self.ready:
                self.ready = self.more()
                if not self.ready:
                    raise ValueError("a record is shorter than its Content-Length")
            piece, self.ready = self.ready[:n], self.ready[n:]
            n -= len(piece)
            yield piece

    def rest(self) -> bytes:
        out = self.ready
        while piece := self.more():
            out += piece
            if len(out) > 64:
                raise ValueError("a record is longer than its Content-Length")
        return out


def _fields(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.decode().split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


class _Sums:
    """Digests of a stream of bytes: SHA-1, and those its headers name."""

    def __init__(self, *claims: str):
        names = {"sha1", *(c.partition(":")[0].lower().replace("-", "") for c in claims)}
        self.sums = {n: hashlib.new(n) for n in names if n in hashlib.algorithms_available and not n.startswith("shake")}

    def update(self, piece: bytes) -> None:
        for h in self.sums.values():
            h.update(piece)

    def fits(self, claim: str) -> bool:
        """Whether a claim ``algorithm:value``, in base32 or hexadecimal of
        either case, is true; an algorithm nobody knows here cannot be judged."""
        name, _, value = claim.partition(":")
        h = self.sums.get(name.lower().replace("-", ""))
        return h is None or value.lower() == h.hexdigest() or value.upper().rstrip("=") == base64.b32encode(h.digest()).decode().rstrip("=")


def read_records(source: IO[bytes], keep_payload: bool = False) -> Iterator[Record]:
    """The records of an archive in order, of any type; raises ValueError for a
    broken frame or a digest that does not fit.

    Digests are optional: those a record has are verified, in any algorithm,
    base32 or hexadecimal.  ``payload_digest`` of a record is its SHA-1
    as bare upper-case base32, computed where the record names none."""
    pending = source.read(CHUNK)
    while pending:
        m = _Member(source, pending)
        first = m.until(b"\r\n\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError("a record does not begin with a WARC version")
        headers = _fields(first)
        if not headers.get("content-length", "").isdecimal():
            raise ValueError("a record has no Content-Length")
        claims = [headers.get(f"warc-{k}-digest", "") for k in ("block", "payload")]
        block, payload, kept, seen, http_head = _Sums(claims[0]), _Sums(claims[1]), [], 0, b""
        in_http = headers.get("content-type", "").startswith("application/http")
        for piece in m.take(int(headers["content-length"])):
            block.update(piece)
            if in_http:
                http_head += piece
                at = http_head.find(b"\r\n\r\n")
                if at < 0:
                    if len(http_head) > MAX_HEADER:
                        raise ValueError("an HTTP header does not end")
                    continue
                piece, http_head, in_http = http_head[at + 4:], http_head[:at + 4], False
            payload.update(piece)
            seen += len(piece)
            if keep_payload:
                kept.append(piece)
        if m.rest() != b"\r\n\r\n":
            raise ValueError("a record does not end with two line ends")
        http, revisit = _fields(http_head), headers.get("warc-type") == "revisit"
        if claims[0] and not block.fits(claims[0]):
            raise ValueError("a block digest does not fit")
        # a revisit's digest is that of the payload it refers to; a truncated one cannot fit
        if claims[1] and not (revisit or "warc-truncated" in headers) and not payload.fits(claims[1]):
            raise ValueError("a payload digest does not fit")
        said = http.get("content-length", "")
        if revisit:
            seen = int(said) if said.isdecimal() else 0
        elif said.isdecimal() and claims[1].startswith("sha1:") and "transfer-encoding" not in http and int(said) != seen:
            raise ValueError("a payload length does not fit")
        named = claims[1].lower().startswith("sha1:") and len(claims[1]) == 37
        yield Record(headers, http, seen, claims[1][5:].upper() if named else digest_of(payload.sums["sha1"]),
                     b"".join(kept) if keep_payload else None)
        pending = m.inflate.unused_data or m.pending or source.read(CHUNK)


def plan(pages: DataFrame, scratch: Scratch, min_revisit_bytes: int = 0) -> DataFrame:
    """``(page_id, url, html, refers_to)``: refers_to is the largest page_id
    with an equal payload, null for that page itself and for payloads under
    ``min_revisit_bytes``."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    key = [F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes")]
    narrow = pages.select(F.col("page_id").cast("bigint").alias("page_id"), *key).where(F.col("bytes") >= min_revisit_bytes)
    narrow = scratch.table(narrow, "payloads")
    last = scratch.table(narrow.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"),
                                                               F.count(F.lit(1)).alias("n"))
                         .where("n > 1 AND refers_to IS NOT NULL").drop("n"), "shared")
    # both are tables, so AQE can split a payload that many pages share
    revisits = (narrow.join(last, ["digest", "bytes"]).where("NOT page_id <=> refers_to")
                .select(F.coalesce("page_id", F.lit(-1)).alias("k"), F.col("page_id").isNull().alias("no_id"), "digest",
                        "refers_to").distinct())
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string"),
                        F.col("html").cast("string"), F.sha1(payload).alias("digest"))
    rows = rows.withColumn("k", F.coalesce("page_id", F.lit(-1))).withColumn("no_id", F.col("page_id").isNull())
    return rows.join(revisits, ["k", "no_id", "digest"], "left").select("page_id", "url", "html", "refers_to")


def write_archives(rows: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """One record per row of ``(page_id, url, html, refers_to)``; returns the
    archives as ``(path, records)``."""
    def run(batches):
        out, path, written, records = None, None, 0, 0
        done = []
        for batch in batches:
            for b in slices(batch, "html"):
                cols = (b.column("page_id").to_pylist(), b.column("url").to_pylist(), utf8(b.column("html")),
                        b.column("refers_to").to_pylist())
                for page_id, url, payload, refers_to in zip(*cols):
                    if out is None:
                        path, written, records = files.new_path(folder, ".warc.gz"), 0, 0
                        out = files.create(path)
                    data = member(render(page_id, url, payload, digest_of(hashlib.sha1(payload)), refers_to))
                    out.write(data)
                    written, records = written + len(data), records + 1
                    if written >= roll:
                        out.close()
                        done.append((path, records))
                        out = None
        if out is not None:
            out.close()
            done.append((path, records))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], names=["path", "records"])
    return rows.mapInArrow(run, "path string, records bigint")


def read_archives(archives: DataFrame) -> DataFrame:
    """``archives(path)`` -> one row per record: page_id, payload_bytes,
    payload_digest, record_type, refers_to, target_uri."""
    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def run(batches):
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            for path in b.column("path").to_pylist():
                rows = []
                with files.open_stream(path) as f:
                    for r in read_records(f):
                        h = r.headers
                        rows.append((number(h.get("x-page-id")), r.payload_bytes, r.payload_digest, h["warc-type"],
                                     number(h.get("x-refers-to-page-id")), h.get("warc-target-uri")))
                        if len(rows) == 4096:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)
    return archives.select("path").mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, target_uri string")


def round_trip(pages: DataFrame, scratch: Scratch, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` to archives and read them back.

    One record per row, also for null or repeated ids: a null html is an empty
    payload, a null url becomes a ``urn:page:`` target; of rows with equal
    payloads those with the largest page_id are responses (all of them if none
    has an id).  Other columns are ignored; an empty table gives no archive.
    """
    archives = scratch.table(write_archives(plan(pages, scratch, min_revisit_bytes), scratch.path("archives")), "manifest")
    scratch.drop("payloads", "shared")
    n = max(1, archives.count())
    return read_archives(archives.repartition(n))
