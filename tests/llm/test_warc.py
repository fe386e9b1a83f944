import base64
import hashlib
import io

import pytest

from commitlens.llm.warc import read_records, read_warc, record_bytes, write_warc

ROWS = [
    (3, "http://a/", "<p>x</p>"),
    (1, None, "<p>x</p>"),
    (2, "http://b/%7E\r\nX: y", "é" * 50_000),
    (None, "http://c", "<p>x</p>"),
    (4, "", None),
    (5, "http://d", ""),
    (6, "http://e", "one of its kind\r\n\r\nwith blank lines"),
    (1, None, "<p>x</p>"),
]
SCHEMA = "page_id long, url string, html string"


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, url, html in rows:
        html = html or ""
        refers_to = first.get(html) if len(html.encode()) >= least and sum((r[2] or "") == html for r in rows) > 1 else None
        refers_to = None if refers_to == page_id else refers_to
        kind = "response" if refers_to is None else "revisit"
        out.append((page_id, url, len(html.encode()), sha1(html), kind, refers_to, "ok"))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 1, 9])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, 1, "z") for r in ROWS], SCHEMA + ", digest long, refers_to string").repartition(3)
    found = read_warc(write_warc(pages, min_revisit_bytes=least)).collect()
    assert sorted((tuple(r)[:7] for r in found), key=repr) == expected(ROWS, least)
    for r in found:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        if r["payload"] is not None:
            assert sha1(r["payload"].decode()) == r["payload_digest"]


def test_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html")
    found = read_warc(write_warc(pages), payload=False).drop("payload").collect()
    assert sorted(map(tuple, found), key=repr) == expected([tuple(r) for r in pages.collect()])


def test_empty_table(spark):
    assert read_warc(write_warc(spark.createDataFrame([], SCHEMA))).count() == 0


class Dribble(io.BytesIO):
    """Gives a few bytes at a time."""

    def read(self, n=-1):
        return super().read(min(n, 7) if n > 0 else n)


def test_reader_takes_any_pieces():
    raw = record_bytes(1, "http://a", b"abc" * 1000) + record_bytes(2, None, b"", refers_to=1)
    one, two = read_records(Dribble(raw), payload=True)
    assert (one.payload, one.status, one.url) == (b"abc" * 1000, "ok", "http://a")
    assert (two.page("refers-to-page-id"), two.status, two.payload) == (1, "ok", None)


def test_broken_archives_are_told():
    raw = record_bytes(1, "http://a", b"abc" * 1000)
    assert [r.status for r in read_records(io.BytesIO(raw + raw[:-30]))] == ["ok", "truncated"]
    assert [r.status for r in read_records(io.BytesIO(raw + b"no gzip"))] == ["ok", "truncated"]
    import zlib

    text = zlib.decompress(raw, 31).replace(b"abcabc", b"abcabd", 1)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    assert [r.status for r in read_records(io.BytesIO(packer.compress(text) + packer.flush()))] == ["digest"]
