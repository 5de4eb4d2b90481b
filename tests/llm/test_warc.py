import base64
import gzip
import hashlib
import re
import time

from ferryline.llm.warc import derive_records, facts, plain_text, write_warc
from ferryline.sources.collections import table

DATE = "2024-02-01T00:00:00Z"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_name_their_source(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    rows = derive_records(pages, DATE).collect()
    html = {r.page_id: r.html for r in pages.collect()}
    assert len(rows) == 3 * len(html) and len({r.record_id for r in rows}) == len(rows)
    source = {r.page_id: r for r in rows if r.type == "response"}
    for r in rows:
        assert r.block_digest == sha1(bytes(r.block)) and r.content_length == len(r.block)
        assert r.payload_digest == sha1(html[r.page_id].encode())
        assert r.refers_to == (None if r.type == "response" else source[r.page_id].record_id)
        if r.type == "conversion":
            assert bytes(r.block).decode() == plain_text(html[r.page_id]) and "<" not in re.sub(r"&", "", bytes(r.block).decode())[:50]
        if r.type == "metadata":
            assert f"source-record: {r.refers_to}\r\n".encode() in bytes(r.block)
        if r.type == "response":
            assert bytes(r.block).split(b"\r\n\r\n", 1)[1] == html[r.page_id].encode()


def test_text_and_links():
    page = '<!DOCTYPE html><html lang="de"><head><title>A &amp; B</title><style>p{}</style></head><body><!-- <a href="x">no</a> -->' \
        "<script>var t='</p>';</script><p>One <b>two</b>&nbsp;3 &lt; 4</p><a class=z href='/l?a=1&amp;b=2'>link</a><br>end"
    assert plain_text(page) == "One two 3 < 4\nlink\nend"
    assert facts(page) == {"title": ["A & B"], "language": ["de"], "outlink": ["/l?a=1&b=2"]}
    assert plain_text("") == "" and plain_text("<script>never closed") == ""


def test_files_read_back(spark, tmp_path):
    records = derive_records(table(spark, "/root/testdata/sf0.001", "pages"), DATE)
    files = write_warc(records, f"{tmp_path}/w").collect()
    assert sum(f.records for f in files) == records.count()
    want = {r.record_id: bytes(r.block) for r in records.collect()}
    for f in files:
        data = gzip.open(f.file).read()
        while data:
            head, rest = data.split(b"\r\n\r\n", 1)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1") and rest[:size] == want.pop(fields["WARC-Record-ID"])
            data = rest[size + 4:]
    assert not want


def test_odd_rows(spark):
    shape = "page_id bigint, url string, html string, type string, block string"
    rows = [(None, None, None, "a", "b"), (1, "", "", "a", "b"), (2, "http://a/\nb", "<p>x" * 5000, "a", "b"), (2, "http://a/\nb", "<p>x" * 5000, "a", "b")]
    got = derive_records(spark.createDataFrame(rows, shape), DATE).collect()
    assert len(got) == 12 and len({r.record_id for r in got}) == 9
    assert derive_records(spark.createDataFrame([], shape), DATE).count() == 0


def test_unclosed_tags_of_a_megabyte():
    """Pages of unclosed tags are looked through once."""
    for piece in ("<a x", "<html x", "<title>", "<p y", "<!", "<script", "< ", "<a href=", "<a  "):
        page = piece * (1_000_000 // len(piece))
        start = time.perf_counter()
        plain_text(page), facts(page)
        assert time.perf_counter() - start < 10
