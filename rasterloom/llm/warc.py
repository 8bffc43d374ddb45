"""Derived WARC records: metadata and plain text of captured responses.

Each response gives two records that refer to it by its id. The metadata record
holds the source's HTTP headers, title, links and digests as JSON and names the
conversion record; the conversion record holds the page's text and names the
metadata record as concurrent. Both keep the target URI, the date and the
source's payload digest. Ids are derived from the response's id, so a repeated
run, or a repeated row, gives the same records.

A null page or URL counts as empty. Tags that are never closed end with the page.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rasterloom.llm.texts import sliced

CAPTURED = "2024-01-01T00:00:00Z"

# Elements whose content is no text, and those that end a line.
SILENT = ("script", "style", "noscript", "template", "svg", "iframe")
BREAKING = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header"
    " hr html li main nav ol option p pre section select table tbody td tfoot th thead title tr ul".split()
)

# What stands in a tag: a value in quotes may hold any sign, also the one that ends tags.
_WITHIN = r"""(?:[^>=]+|=\s*"[^"]*"|=\s*'[^']*'|=)*+"""
_MARK = re.compile(rf"<!--.*?(?:-->|\Z)|<({'|'.join(SILENT)})\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_WITHIN})(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TITLE = re.compile(rf"<title\b{_WITHIN}>(.*?)(?:</title\s*>|\Z)", re.S | re.I)


def attribute(within: str, name: str) -> str | None:
    """The value of a tag's first attribute of this name, None without one."""
    for found in _ATTRIBUTE.finditer(within):
        if found[1].lower() == name:
            return html.unescape(next((value for value in found.groups()[1:] if value is not None), ""))
    return None


def plain_text(page: str) -> tuple[str, list[str]]:
    """The page's text, a line per block without blank lines, and the targets of its links in order."""
    links: list[str] = []

    def replaced(mark: re.Match) -> str:
        name = mark[3]
        if name is None:
            return " " if mark[1] else ""
        name = name.lower()
        if name == "a" and not mark[2] and (href := attribute(mark[4], "href")) is not None:
            links.append(href)
        return "\n" if name in BREAKING else ""

    # line ends of the source are blanks; only blocks make lines
    text = html.unescape(_MARK.sub(replaced, " ".join(page.split())))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line), links


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(json.dumps(parts).encode()).digest()[:16], version=4)}>"


def responses(pages: DataFrame, captured: str = CAPTURED) -> DataFrame:
    """Pages as WARC response records: id, URI, date, HTTP header and payload."""
    header = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    held = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("target_uri"), F.coalesce("html", F.lit("")).alias("payload"))
    name = F.sha2(F.concat_ws("\x1f", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri", F.sha2("payload", 256)), 256)
    uid = F.concat(*[part for i, (at, n) in enumerate([(1, 8), (9, 4), (14, 3), (18, 3), (21, 12)]) for part in ((F.lit(("<urn:uuid:", "-", "-4", "-8", "-")[i])), F.substring(name, at, n))], F.lit(">"))
    return held.select("page_id", uid.alias("record_id"), "target_uri", F.lit(captured).alias("warc_date"), header.alias("http_header"), "payload")


DERIVED = (
    "page_id long, warc_type string, record_id string, refers_to string, concurrent_to string, target_uri string, warc_date string,"
    " content_type string, content_length long, block_digest string, source_payload_digest string, source_header string, block string"
)
COLUMNS = [part.split()[0] for part in DERIVED.split(",")]


def derive(records: DataFrame) -> DataFrame:
    """The metadata and the conversion record of every response. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "payload"):
            made = []
            for page_id, source, uri, date, header, payload in zip(*(part.column(i).to_pylist() for i in range(6))):
                text, links = plain_text(payload)
                title = _TITLE.search(payload)
                source_digest = digest(payload.encode())
                meta_id, text_id = record_id(source, "metadata"), record_id(source, "conversion")
                block = {
                    "headers": [line.split(": ", 1) for line in header.split("\r\n")[1:] if line],
                    "status": header.split("\r\n", 1)[0],
                    "title": " ".join(html.unescape(title[1]).split()) if title else "",
                    "links": links,
                    "payload_digest": source_digest,
                    "payload_length": len(payload.encode()),
                    "conversion": text_id,
                }
                for kind, own, other, form, content in (
                    ("metadata", meta_id, text_id, "application/json", json.dumps(block, ensure_ascii=False)),
                    ("conversion", text_id, meta_id, "text/plain; charset=utf-8", text),
                ):
                    raw = content.encode()
                    made.append((page_id, kind, own, source, other, uri, date, form, len(raw), digest(raw), source_digest, header, content))
            kinds = [pa.int64() if name in ("page_id", "content_length") else pa.string() for name in COLUMNS]
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*made), kinds)], names=COLUMNS)

    order = ("page_id", "record_id", "target_uri", "warc_date", "http_header", "payload")
    return records.select(*order).mapInArrow(run, DERIVED)


def serialized(derived: DataFrame) -> DataFrame:
    """``record_id`` and the ``record`` as it stands in a WARC file."""
    fields = [("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"), ("WARC-Refers-To-Payload-Digest", "source_payload_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    lines = [part for name, column in fields for part in (F.lit(f"{name}: "), F.col(column).cast("string"), F.lit("\r\n"))]
    return derived.select("record_id", F.encode(F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"), "block", F.lit("\r\n\r\n")), "utf-8").alias("record"))
