"""WARC derivative builder.

A captured page becomes a WARC ``response`` record; the builder reads
response records (never the page table) and writes, for each, a ``metadata``
record (the response's headers, HTTP status, title, language and links, as
JSON) and a ``conversion`` record (the page's plain text). Both name the
response in ``WARC-Refers-To``, carry its target URI and date, and repeat its
block and payload digests; each record has digests of its own.

Records are complete byte strings (header, block, two line ends), so their
concatenation is a WARC file: ``write_files`` does that with Spark's writer.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare

#: The page table has no capture time; records carry this one.
CAPTURE_DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"

RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("target_uri", T.StringType()), T.StructField("content_type", T.StringType()),
    T.StructField("content_length", T.LongType()), T.StructField("block_digest", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("source_block_digest", T.StringType()),
    T.StructField("record", T.BinaryType())])


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(*parts: str) -> str:
    """A stable id: the same record of the same content has the same one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", value).strip()


def build(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {_clean(v)}".encode() for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])]
    return CRLF.join(lines) + CRLF + CRLF + block + CRLF + CRLF


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-cased names, block) of one record."""
    head, _, rest = record.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.decode("utf-8").partition(":")
        headers[name.strip().lower()] = value.strip()
    return headers, rest[:int(headers["content-length"])]


def response_record(page_id: int | None, url: str | None, page: str | None, date: str = CAPTURE_DATE) -> bytes:
    """Response of one captured page. A NULL url has no WARC-Target-URI, a
    NULL page an empty body."""
    payload = (page or "").encode("utf-8")
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode("ascii") + CRLF + CRLF)
    block = http + payload
    headers = [("WARC-Record-ID", record_id("response", str(page_id), url or "", digest(payload))), ("WARC-Date", date)]
    if url:
        headers.append(("WARC-Target-URI", url))
    headers += [("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
                ("WARC-Source-Page", str(page_id)), ("Content-Type", "application/http; msgtype=response")]
    return build("response", headers, block)


# -------------------------------------------------------------- plain text
_BLOCKS = frozenset(("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li "
                     "main nav ol p pre section table tbody td tfoot th thead title tr ul").split())
_SILENT = frozenset(("script", "style"))
#: Silent where they are closed; an unclosed one would take the rest of the page.
_SILENT_CLOSED = frozenset(("template", "noscript", "iframe"))


class _Page(HTMLParser):
    """Text, title, language and links of a page; text inside silent
    elements is left out, block elements end a line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.title: list[str] = []
        self.links: list[str] = []
        self.lang = ""
        self.silent, self.in_title = 0, False
        self.breaks = 0
        self.open: list[tuple[str, int, int, int]] = []  # _SILENT_CLOSED tags; parts, title and breaks before them

    def handle_starttag(self, tag, attrs):
        named = {k: v for k, v in attrs if v is not None}
        if tag == "html" and not self.lang:
            self.lang = named.get("lang", "")
        if tag in ("a", "area") and named.get("href"):
            self.links.append(named["href"])
        if tag in _SILENT:
            self.silent += 1
        elif tag in _SILENT_CLOSED:
            self.open.append((tag, len(self.parts), len(self.title), self.breaks))
        elif tag == "title":
            self.in_title = True
        self._break(tag)

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in _SILENT_CLOSED:
            self._leave_out(tag)
        elif tag == "title":
            self.in_title = False
        self._break(tag)

    def _break(self, tag):
        if tag in _BLOCKS:
            self.parts.append("\n")
            self.breaks += 1

    def _leave_out(self, tag):
        """Drop the text since the last open ``tag``; its line ends stay."""
        if all(t != tag for t, *_ in self.open):
            return
        while True:
            name, parts, title, breaks = self.open.pop()
            if name == tag:
                break
        del self.parts[parts:], self.title[title:]
        if self.breaks > breaks:
            self.parts.append("\n")

    def handle_data(self, data):
        if self.silent:
            return
        if self.in_title:
            self.title.append(data)
        else:
            self.parts.append(data)


def read_page(page: str) -> tuple[str, str, str, list[str]]:
    """(plain text, title, language, links) of HTML. Lines have their white
    space folded; empty lines are dropped."""
    p = _Page()
    p.feed(page)
    p.close()
    lines = (" ".join(line.split()) for line in "".join(p.parts).split("\n"))
    return "\n".join(line for line in lines if line), " ".join("".join(p.title).split()), p.lang, p.links


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers, payload) of an HTTP response block."""
    head, _, payload = block.partition(CRLF + CRLF)
    first, *rest = head.decode("iso-8859-1").split("\r\n")
    return first, [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in rest)], payload


def charset_of(http: list[tuple[str, str]]) -> str:
    for name, value in http:
        m = re.search(r"charset=[\"']?([\w.:-]+)", value, re.I)
        if name.lower() == "content-type" and m:
            return m[1]
    return "utf-8"


def derive(record: bytes) -> list[tuple[str, dict[str, str], bytes]]:
    """(kind, headers, record) of the metadata and conversion records of one
    response record. Any other record type has no derivatives."""
    head, block = parse(record)
    if head.get("warc-type") != "response":
        return []
    status, http, payload = split_http(block)
    try:
        page = payload.decode(charset_of(http), "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    text, title, lang, links = read_page(page)
    uri = head.get("warc-target-uri", "")
    source = head["warc-record-id"]
    resolved = []
    for link in links:
        try:
            resolved.append(urljoin(uri, link.strip()))
        except ValueError:
            resolved.append(link.strip())
    about = {"Envelope": {"WARC-Header-Metadata": {k: v for k, v in head.items()},
                          "Payload-Metadata": {"Response-Line": status, "Headers": [list(h) for h in http],
                                               "HTML-Metadata": {"Title": title, "Language": lang, "Links": resolved}}}}
    shared = [("WARC-Refers-To", source), ("WARC-Date", head.get("warc-date", CAPTURE_DATE))]
    if uri:
        shared += [("WARC-Target-URI", uri), ("WARC-Refers-To-Target-URI", uri)]
    shared += [("WARC-Refers-To-Date", head.get("warc-date", CAPTURE_DATE)),
               ("WARC-Source-Block-Digest", head.get("warc-block-digest", digest(block))),
               ("WARC-Source-Payload-Digest", head.get("warc-payload-digest", digest(payload)))]
    out = []
    for kind, mime, data in (("metadata", "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True).encode("utf-8")),
                             ("conversion", "text/plain; charset=utf-8", text.encode("utf-8"))):
        headers = [("WARC-Record-ID", record_id(kind, source)), *shared, ("WARC-Block-Digest", digest(data)), ("Content-Type", mime)]
        if lang and kind == "conversion":
            headers.append(("WARC-Identified-Content-Language", lang))
        out.append((kind, dict(headers), build(kind, headers, data)))
    return out


def responses(pages: DataFrame, date: str = CAPTURE_DATE) -> DataFrame:
    """(page_id, record): one response record per page. NULL url and html are
    kept as described in ``response_record``; repeated rows repeat."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, html = (batch.column(c).to_pylist() for c in ("page_id", "url", "html"))
            rows = [response_record(i, u, h, date) for i, u, h in zip(ids, urls, html, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), pa.array(rows, pa.binary())], ["page_id", "record"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, record binary")


def derivatives(source: DataFrame) -> DataFrame:
    """``RECORD`` rows: the metadata and conversion record of every response
    record in (page_id, record). NULL records and other record types give no
    rows; an empty table gives no rows."""
    prepare(source.sparkSession)
    names = RECORD.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, raw in zip(batch.column("page_id").to_pylist(), batch.column("record").to_pylist(), strict=True):
                for kind, head, record in derive(raw) if raw else ():
                    length = len(parse(record)[1])
                    rows.append((page_id, kind, head["WARC-Record-ID"], head["WARC-Refers-To"], head.get("WARC-Target-URI"), head["Content-Type"],
                                 length, head["WARC-Block-Digest"], head["WARC-Source-Payload-Digest"], head["WARC-Source-Block-Digest"], record))
            if rows:
                kinds = [pa.int64(), *[pa.string()] * 5, pa.int64(), *[pa.string()] * 3, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return source.select("page_id", "record").mapInArrow(run, RECORD)


def write_files(records: DataFrame, folder: str) -> None:
    """Each partition's records as one WARC file (gzip) in ``folder``."""
    # the writer ends each row with the line separator: the record's own last line end
    text = F.decode(F.expr("substring(record, 1, length(record) - 2)"), "UTF-8")
    records.select(text.alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").text(folder)
