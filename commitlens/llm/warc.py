"""Operator 3: web archives, one gzip member per record, written and read in sequence.

The reader holds one record at a time: it inflates a member piece by piece,
frames header and block by `Content-Length`, and checks the digests while the
bytes pass. Repeated payloads are stored once; later ones are `revisit` records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.shared_files import attempt_path, open_input, open_output
from commitlens.llm.tokens import slices
from commitlens.scratch import fresh_folder, stored

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"
READ_BYTES = 1 << 18


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _one_line(value: str) -> str:
    """A header's value: control characters and percent signs before them are escaped."""
    if value.isprintable() and "%" not in value and value == value.strip():
        return value
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or c in "%\x7f" else c for c in value)


def _whole(value: str | None) -> str | None:
    if value is None or "%" not in value:
        return value
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = NO_DATE
) -> bytes:
    """One record as a gzip member: a response, or with `refers_to` a revisit of that page."""
    digest, revisit = base32_sha1(payload), refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
    block = block % len(payload) + (b"" if revisit else payload)
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _one_line(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "WARC-Refers-To": _record_id(refers_to) if revisit else None,
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "Page-ID": page_id,
        "Refers-To-Page-ID": refers_to,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = [VERSION, *(f"{name}: {value}" for name, value in head.items() if value is not None)]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


@dataclass
class Record:
    headers: dict[str, str]
    payload_bytes: int
    payload_digest: str
    # `ok`, `digest` (a stored digest is wrong) or `truncated`.
    status: str
    payload: bytes | None = field(default=None, repr=False)

    def page(self, name: str) -> int | None:
        value = self.headers.get(name)
        return None if value is None else int(value)

    @property
    def url(self) -> str | None:
        return _whole(self.headers.get("warc-target-uri"))


class _Framed:
    """Takes a record's inflated bytes in any pieces; counts and digests its block."""

    def __init__(self, keep: bool):
        self.keep, self.head, self.headers = keep, b"", None
        self.left = self.payload_bytes = 0
        self.http: bytes | None = b""
        self.block, self.payload, self.kept = hashlib.sha1(), hashlib.sha1(), []

    def feed(self, data: bytes) -> None:
        if self.headers is None:
            self.head += data
            head, end, data = self.head.partition(b"\r\n\r\n")
            if not end:
                return
            lines = head.decode("utf-8", "replace").split("\r\n")
            pairs = (line.partition(":")[::2] for line in lines[1:])
            self.headers = {name.strip().lower(): value.strip() for name, value in pairs}
            self.left, self.head = int(self.headers.get("content-length", 0)), b""
        data = data[: self.left]
        self.left -= len(data)
        self.block.update(data)
        if self.http is not None:
            self.http += data
            http, end, data = self.http.partition(b"\r\n\r\n")
            if not end:
                return
            self.http_head, self.http = http, None
        self.payload.update(data)
        self.payload_bytes += len(data)
        if self.keep:
            self.kept.append(data)

    def record(self, whole: bool) -> Record:
        headers = self.headers or {}
        stored_digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        revisit = headers.get("warc-type") == "revisit"
        n, digest = self.payload_bytes, base64.b32encode(self.payload.digest()).decode()
        good = headers.get("warc-block-digest", "sha1:" + base64.b32encode(self.block.digest()).decode())
        good = good == "sha1:" + base64.b32encode(self.block.digest()).decode()
        if revisit:
            # The payload stands elsewhere; its length and digest are stated here.
            lines = getattr(self, "http_head", b"").lower().split(b"\r\n")
            n = next((int(x.split(b":")[1]) for x in lines if x.startswith(b"content-length:")), 0)
            digest = stored_digest
        elif stored_digest:
            good = good and digest == stored_digest
        status = "truncated" if not whole or self.left or self.headers is None else "ok" if good else "digest"
        payload = b"".join(self.kept) if self.keep and not revisit else None
        return Record(headers, n, digest, status, payload)


def read_records(stream: BinaryIO, payload: bool = False) -> Iterator[Record]:
    """Records of an archive in order; after a broken member nothing more is read."""
    raw = stream.read(READ_BYTES)
    while raw:
        inflate, framed = zlib.decompressobj(31), _Framed(payload)
        try:
            while raw and not inflate.eof:
                framed.feed(inflate.decompress(raw))
                raw = inflate.unused_data if inflate.eof else stream.read(READ_BYTES)
        except zlib.error:
            yield framed.record(whole=False)
            return
        yield framed.record(whole=inflate.eof)
        raw = raw or stream.read(READ_BYTES)


def _write_archive(folder: str, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path = attempt_path(folder, f"part-{TaskContext.get().partitionId():06d}", ".warc.gz")
        out, n = None, 0
        for batch in batches:
            for part in slices(batch):
                out = out or open_output(path)
                for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                    out.write(record_bytes(page_id, url, html.encode(), refers_to, date))
                n += part.num_rows
        if out is not None:
            out.close()
            yield pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], ["path", "n_records"])

    return write


def write_warc(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_revisit_bytes: int = 0,
    date: str = NO_DATE,
) -> DataFrame:
    """Write a record per row; returns the manifest `(path, n_records)`, one row per archive.

    Of rows with equal payloads of at least `min_revisit_bytes` bytes, that with
    the smallest key is a response, the others revisit it; rows that repeat that
    smallest key are responses too. A null html is an empty payload. A row with a
    null key revisits like others, but nothing revisits it. A null url has no
    header. Other columns are not read; an empty table has no archive.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    enough = F.octet_length("html") >= min_revisit_bytes
    # Stored, so that the join may split a payload that very many pages share.
    repeated = stored(
        rows.filter(enough)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    refers_to = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    linked = rows.join(repeated, "digest", "left").select("key", "url", "html", refers_to.alias("refers_to"))
    folder = fresh_folder(pages.sparkSession)
    return stored(linked.mapInArrow(_write_archive(folder, date), "path string, n_records long"))


_READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, status string, payload binary"
)


def read_warc(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """One row per record of the archives that `path` names; a task reads whole archives.

    `status` is `ok`, `digest` where bytes do not fit their digest, or `truncated`
    where an archive breaks off. Without `payload` that column is null and a
    record of any size passes in pieces.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64())]
            + [("payload_digest", pa.string()), ("record_type", pa.string())]
            + [("refers_to", pa.int64()), ("status", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_input(path) as stream:
                    for r in read_records(stream, payload):
                        kind, pages = r.headers.get("warc-type"), (r.page("page-id"), r.page("refers-to-page-id"))
                        rows.append(
                            (pages[0], r.url, r.payload_bytes, r.payload_digest, kind, pages[1], r.status, r.payload)
                        )
                        held += len(r.payload or b"")
                        if len(rows) == 1024 or held > 1 << 24:
                            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    tasks = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path").repartition(tasks).mapInArrow(read, _READ)
