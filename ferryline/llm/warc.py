"""WARC derivatives: metadata and conversion records linked to the responses they come from.

A response record is a web page with its HTTP header. Of each, a metadata record tells title, language, links and digests,
and a conversion record holds its plain text. Both name the response in ``WARC-Refers-To`` and keep its target, date and
payload digest. Record ids are made from the response's id and the record's type, so a repeated run gives the same ones.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_OF_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs, RFC 4122
RECORD = "record_id string, type string, refers_to string, target_uri string, date string, content_type string, " \
    "payload_digest string, block_digest string, content_length bigint, block binary"
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|head)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
# A tag ends at the next '<' at the latest, so an unclosed one is looked through once.
_BREAK = re.compile(r"</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|blockquote|pre)\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[A-Za-z!?][^<>]*(?:>|\Z)")
_TITLE, _TITLE_END = re.compile(r"<title\b[^<>]*>", re.I), re.compile(r"</title\s*>", re.I)
_ANCHOR, _ROOT = re.compile(r"<a\b([^<>]*)", re.I), re.compile(r"<html\b([^<>]*)", re.I)
_HREF = re.compile(r"\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LANG = re.compile(r"\slang\s*=\s*[\"']?([A-Za-z-]+)", re.I)


def plain_text(page: str) -> str:
    """Visible text: one line for each block of the page, white space as single spaces, entities as characters."""
    shown = _TAG.sub("", _BREAK.sub("\n", _HIDDEN.sub(" ", page)))
    lines = (" ".join(line.split()) for line in entities.unescape(shown).split("\n"))
    return "\n".join(line for line in lines if line)


def facts(page: str) -> dict[str, list[str]]:
    """Title, language and links of a page, in their order."""
    start, root = _TITLE.search(page), _ROOT.search(page)
    end = _TITLE_END.search(page, start.end()) if start else None
    title = [" ".join(entities.unescape(page[start.end():end.start()]).split())] if end else []
    language = _LANG.search(root[1]) if root else None
    found = (_HREF.search(m[1]) for m in _ANCHOR.finditer(_HIDDEN.sub(" ", page)))
    links = [entities.unescape(next(x for x in m.groups() if x is not None)) for m in found if m]
    return {"title": title, "language": [language[1]] if language else [], "outlink": links}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_OF_IDS, '|'.join(names))}>"


def _one_line(value: str) -> str:
    return " ".join(value.split())


def _derived(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([(n, {"binary": pa.binary(), "bigint": pa.int64()}.get(t, pa.string()))
                           for n, t in (f.strip().split(" ") for f in f"page_id bigint, {RECORD}".split(","))])
        for batch in batches:
            rows = []
            for page_id, url, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
                target, payload = _one_line(url or ""), (page or "").encode()
                header = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                names = ("" if page_id is None else str(page_id), target, digest(payload))
                source = record_id("response", *names)
                told = {"source-record": [source], "source-type": ["response"], "http-status": ["200"],
                        "http-content-type": ["text/html; charset=utf-8"], **facts(page or "")}
                fields = "".join(f"{k}: {_one_line(v)}\r\n" for k, values in told.items() for v in values).encode()
                blocks = (("response", None, "application/http; msgtype=response", header.encode() + payload),
                          ("metadata", source, "application/warc-fields", fields),
                          ("conversion", source, "text/plain; charset=utf-8", plain_text(page or "").encode()))
                for kind, refers, content, block in blocks:
                    rows.append((page_id, source if kind == "response" else record_id(kind, *names), kind, refers, target, date,
                                 content, digest(payload), digest(block), len(block), block))
                if len(rows) >= 600:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)
    return run


def derive_records(pages: DataFrame, date: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response, metadata and conversion record of every page, as rows ``page_id`` and the fields of a WARC record.

    ``date``: the time of the capture, as in ``2024-02-01T00:00:00Z``; a repeated run gives the same records.

    Nulls: a null page is an empty one with an empty conversion; a null url is an empty target; a null id is empty in the
    record's name. Repeated rows give equal records with equal ids. An empty table gives an empty result. Other columns
    are ignored, whatever their names.
    """
    read = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return read.mapInArrow(_derived(date), f"page_id bigint, {RECORD}")


def record_bytes(row: dict) -> bytes:
    """One record of a WARC 1.1 file."""
    head = [("WARC-Type", row["type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]),
            ("WARC-Target-URI", row["target_uri"]), ("WARC-Refers-To", row["refers_to"]),
            ("WARC-Payload-Digest", row["payload_digest"] if row["type"] == "response" else None),
            ("WARC-Source-Payload-Digest", row["payload_digest"] if row["type"] != "response" else None),
            ("WARC-Block-Digest", row["block_digest"]), ("Content-Type", row["content_type"]),
            ("Content-Length", str(row["content_length"]))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + row["block"] + b"\r\n\r\n"


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        name, draft, sink, count = f"{root}/part-{part:06d}.warc.gz", f"{root}/draft-{part:06d}-{uuid.uuid4().hex}", None, 0
        for batch in batches:
            if sink is None:
                store.create_dir(root, recursive=True)
                sink = store.open_output_stream(draft, compression=None)
            for row in batch.to_pylist():
                sink.write(gzip.compress(record_bytes(row), mtime=0))  # a member each, so readers may start at any record
                count += 1
        if sink is not None:
            sink.close()
            store.move(draft, name)
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [count]})
    return run


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Write records to one ``.warc.gz`` file a partition; returns ``file, records``. A repeated task leaves the same file."""
    return records.drop("page_id").mapInArrow(_written(folder), "file string, records bigint")
