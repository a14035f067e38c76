"""Whole result of the WARC query on a given table, against records put
together here: text by regular expressions, headers written out, own digests."""

import base64
import hashlib
import html
import json
import re
import uuid
from urllib.parse import urljoin

import pyarrow.parquet as pq

from ledgerline.llm import warc_derive
from ledgerline.llm.common import ship_package
from ledgerline.llm.queries import queries

SF_DIR = "/root/testdata/sf0.001"
DATE = "2024-01-01T00:00:00Z"
BLOCK = "|".join(sorted(warc_derive._BLOCKS, key=len, reverse=True))


def b32(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(*parts):
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def fold(text):
    return " ".join(html.unescape(text).split())


def plain(page):
    rest = re.sub(r"(?s)<!--.*?-->|<!DOCTYPE[^>]*>", "", page)
    rest = re.sub(r"(?s)<(script|style|noscript|template|iframe)\b[^>]*>.*?</\1>", "", rest)
    title = "".join(re.findall(r"(?s)<title>(.*?)</title>", rest))
    rest = re.sub(r"(?s)<title>.*?</title>", "\n", rest)
    rest = re.sub(rf"</?(?:{BLOCK})(?:\s[^>]*)?/?>", "\n", rest)
    lines = [fold(line) for line in re.sub(r"<[^>]*>", "", rest).split("\n")]
    return "\n".join(line for line in lines if line), fold(title)


def expected(page_id, url, page):
    payload = page.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload
    source = urn("response", str(page_id), url, b32(payload))
    head = {"warc-type": "response", "warc-record-id": source, "warc-date": DATE, "warc-target-uri": url, "warc-payload-digest": b32(payload),
            "warc-block-digest": b32(block), "warc-source-page": str(page_id), "content-type": "application/http; msgtype=response",
            "content-length": str(len(block))}
    text, title = plain(page)
    lang = (re.findall(r'<html[^>]*\blang="([^"]*)"', page) or [""])[0]
    links = [urljoin(url, html.unescape(u).strip()) for u in re.findall(r'<a\b[^>]*\bhref="([^"]+)"', re.sub(r"(?s)<script.*?</script>", "", page))]
    about = {"Envelope": {"WARC-Header-Metadata": head, "Payload-Metadata": {
        "Response-Line": "HTTP/1.1 200 OK", "Headers": [["Content-Type", "text/html; charset=utf-8"], ["Content-Length", str(len(payload))]],
        "HTML-Metadata": {"Title": title, "Language": lang, "Links": links}}}}
    rows = []
    for kind, mime, data in (("metadata", "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True).encode()),
                             ("conversion", "text/plain; charset=utf-8", text.encode())):
        own = urn(kind, source)
        lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", f"WARC-Refers-To: {source}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}",
                 f"WARC-Refers-To-Target-URI: {url}", f"WARC-Refers-To-Date: {DATE}", f"WARC-Source-Block-Digest: {b32(block)}",
                 f"WARC-Source-Payload-Digest: {b32(payload)}", f"WARC-Block-Digest: {b32(data)}", f"Content-Type: {mime}"]
        if lang and kind == "conversion":
            lines.append(f"WARC-Identified-Content-Language: {lang}")
        lines.append(f"Content-Length: {len(data)}")
        record = "\r\n".join(lines).encode() + b"\r\n\r\n" + data + b"\r\n\r\n"
        rows.append((page_id, kind, own, source, url, mime, len(data), b32(data), b32(payload), b32(block), hashlib.sha256(record).hexdigest()))
    return rows


def test_op9_whole_result(spark):
    ship_package(spark)
    pages = pq.read_table(f"{SF_DIR}/pages.parquet", columns=["page_id", "url", "html"]).to_pylist()
    wanted = [row for p in pages for row in expected(p["page_id"], p["url"], p["html"])]
    columns = [c for c in warc_derive.RECORD.names if c != "record"] + ["record_sha256"]
    got = queries()["op9_warc_derivatives"](spark, SF_DIR).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(wanted) and len(wanted) == 2 * len(pages) > 0
