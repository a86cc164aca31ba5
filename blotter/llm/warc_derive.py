"""WARC derivative builder: linked metadata and plain-text conversion records of responses.

``response_records`` makes one response record per page: an HTTP message of
source headers and body. ``derive_records`` makes two records of every
response, both with ``WARC-Refers-To`` the response's record id and the
response's target URI:

* metadata (``application/warc-fields``): the source's headers, its block
  and payload digests, the title, the outlinks and the text's length;
* conversion (``text/plain``): all visible text, one line per block, with
  the digest of the source payload carried over.

``record_bytes`` renders any of them as WARC/1.1. Record ids are
name-based (UUID from a digest of type, URI, page and payload), so a lost
task that runs again makes the same ids, and repeated rows the same
records. Digests are ``sha256:`` with lowercase hex.

Defined results: a null page is an empty body (its conversion block is
empty); a null URL is an empty target URI; nothing is dropped. Rows are
derived each on their own, so any skew of hosts or copies is without effect.
"""

from __future__ import annotations

import hashlib
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts
from .html_blocks import text_blocks

HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
TITLE, TITLE_END = re.compile("<title", re.I), re.compile("</title", re.I)
ANCHOR = re.compile(r"<a\b", re.I)
HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def digest(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """``<urn:uuid:...>`` from a digest of the parts."""
    h = F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def response_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, record_id, target_uri, http_headers, payload, payload_digest, block_digest, content_length) per page."""
    p = pages.select(F.col(id_col).alias("page_id"), F.coalesce(url_col, F.lit("")).alias("target_uri"),
                     F.coalesce(html_col, F.lit("")).alias("payload"))
    p = p.withColumn("http_headers", F.concat(F.lit(HTTP_HEAD), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n")))
    p = p.withColumn("payload_digest", digest(F.col("payload")))
    return p.select("page_id", record_id(F.lit("response"), F.col("target_uri"), F.col("page_id"), F.col("payload_digest")).alias("record_id"),
                    "target_uri", "http_headers", "payload", "payload_digest",
                    digest(F.concat("http_headers", "payload")).alias("block_digest"),
                    F.octet_length(F.concat("http_headers", "payload")).cast("bigint").alias("content_length"))


def outlinks(page: str) -> list[str]:
    """The targets of ``a`` tags in page order; every character is passed a bounded number of times."""
    out, at, end = [], 0, -1
    while (tag := ANCHOR.search(page, at)) is not None:
        if end < tag.end():
            end = page.find(">", tag.end())
            end = len(page) if end < 0 else end
        # No further anchor in this tag could have a link either.
        link = HREF.search(page, tag.end(), end)
        if link is None:
            at = end
            continue
        # A quoted target may hold the character that ends tags.
        link = HREF.match(page, link.start()) or link
        out.append(unescape(link[1] or link[2] or link[3] or ""))
        at = link.end()
    return out


def title(page: str) -> str:
    begin = TITLE.search(page)
    start = page.find(">", begin.end()) + 1 if begin else 0
    if not start:
        return ""
    end = TITLE_END.search(page, start)
    return " ".join(unescape(page[start:end.start() if end else len(page)]).split())


def plain_text(page: str) -> str:
    """All visible text, one line per block."""
    return "\n".join(b.text for b in text_blocks(page))


def metadata_block(source_headers: str, payload_digest: str, block_digest: str, page: str, text: str) -> str:
    """``application/warc-fields``: one ``name: value`` per line; header lines are kept one by one, in order."""
    one = lambda v: " ".join(v.split())
    lines = [("source-header", one(h)) for h in source_headers.split("\r\n") if h]
    lines += [("source-payload-digest", payload_digest), ("source-block-digest", block_digest),
              ("title", title(page)), ("text-length", str(len(text)))]
    lines += [("outlink", one(u)) for u in outlinks(page)]
    return "".join(f"{k}: {v}\r\n" for k, v in lines)


RECORD = ("record_id", "warc_type", "refers_to", "target_uri", "content_type", "source_headers", "source_payload_digest",
          "block_digest", "content_length", "block")


def derive_records(responses: DataFrame) -> DataFrame:
    """(page_id, *RECORD): a metadata and a conversion record of every response, with their blocks."""
    kinds = pa.list_(pa.struct([("warc_type", pa.string()), ("content_type", pa.string()), ("block", pa.string()),
                                ("block_digest", pa.string()), ("content_length", pa.int64())]))

    def start():
        def record(kind: str, content_type: str, block: str) -> dict:
            raw = block.encode("utf-8", "surrogatepass")
            return {"warc_type": kind, "content_type": content_type, "block": block,
                    "block_digest": "sha256:" + hashlib.sha256(raw).hexdigest(), "content_length": len(raw)}

        def run(batch: pa.RecordBatch) -> dict:
            made = []
            for page, head, payload, block in zip(*(texts(batch, c) for c in ("payload", "http_headers", "payload_digest", "block_digest"))):
                text = plain_text(page)
                made.append([record("metadata", "application/warc-fields", metadata_block(head, payload, block, page, text)),
                             record("conversion", "text/plain; charset=utf-8", text)])
            return {"made": made}
        return run

    keep = ["page_id", "record_id", "target_uri", "http_headers", "payload_digest"]
    r = map_batches(responses.select(*keep, "payload", "block_digest"), keep, start, {"made": kinds})
    r = r.select(*keep, F.explode("made").alias("m"))
    return r.select("page_id", record_id(F.col("m.warc_type"), F.col("target_uri"), F.col("page_id"), F.col("payload_digest")).alias("record_id"),
                    "m.warc_type", F.col("record_id").alias("refers_to"), "target_uri", "m.content_type",
                    F.col("http_headers").alias("source_headers"), F.col("payload_digest").alias("source_payload_digest"),
                    "m.block_digest", "m.content_length", "m.block")


def record_bytes(records: DataFrame, date: str) -> DataFrame:
    """(record_id, record): each derived record as WARC/1.1 bytes, dated ``date`` (W3C time, UTC)."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")),
                    line("WARC-Date", F.lit(date)), line("WARC-Target-URI", F.col("target_uri")),
                    line("WARC-Refers-To", F.col("refers_to")), line("WARC-Block-Digest", F.col("block_digest")),
                    line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length").cast("string")),
                    F.lit("\r\n"))
    return records.select("record_id", F.concat(head, F.col("block"), F.lit("\r\n\r\n")).cast("binary").alias("record"))
