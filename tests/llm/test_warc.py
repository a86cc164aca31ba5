import hashlib
import re

from blotter.llm.warc_derive import derive_records, plain_text, record_bytes, response_records

PAGE = '<html><head><title>A &amp; b</title></head><body><p>One &lt;two&gt;</p><p>three <a href="/x?a=1&amp;b=2">four</a></p></body></html>'
ROWS = [(1, "http://a/", PAGE, "x"), (1, "http://a/", PAGE, "x"), (2, None, None, "x"), (3, "http://b/", "", "x"), (None, "http://c/", "é", "x")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, record_id string")


def test_records_are_linked_and_digests_hold(spark):
    responses = response_records(frame(spark))
    source = {r["record_id"]: r for r in responses.collect()}
    derived = derive_records(responses).collect()
    assert len(derived) == 2 * len(ROWS)
    for r in derived:
        s = source[r["refers_to"]]
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r["record_id"]) and r["record_id"] != r["refers_to"]
        assert r["target_uri"] == s["target_uri"] and r["source_headers"] == s["http_headers"]
        assert r["source_payload_digest"] == s["payload_digest"] == "sha256:" + hashlib.sha256(s["payload"].encode()).hexdigest()
        assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest()
        assert r["content_length"] == len(r["block"].encode())
        if r["warc_type"] == "conversion":
            assert r["block"] == plain_text(s["payload"])
        else:
            assert f"source-payload-digest: {s['payload_digest']}\r\n" in r["block"] and f"source-block-digest: {s['block_digest']}\r\n" in r["block"]
    meta = next(r["block"] for r in derived if r["page_id"] == 1 and r["warc_type"] == "metadata")
    assert "title: A & b\r\n" in meta and "outlink: /x?a=1&b=2\r\n" in meta and "source-header: HTTP/1.1 200 OK\r\n" in meta
    assert next(r["block"] for r in derived if r["page_id"] == 1 and r["warc_type"] == "conversion") == "One <two>\nthree four"


def test_rendered_records_parse(spark):
    derived = derive_records(response_records(frame(spark)))
    blocks = {r["record_id"]: r for r in derived.collect()}
    for r in record_bytes(derived, "2020-01-01T00:00:00Z").collect():
        head, rest = bytes(r["record"]).split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert head.startswith(b"WARC/1.1\r\n") and rest[n:] == b"\r\n\r\n"
        assert rest[:n].decode() == blocks[r["record_id"]]["block"] and fields["WARC-Refers-To"] == blocks[r["record_id"]]["refers_to"]


def test_no_rows(spark):
    assert derive_records(response_records(frame(spark).limit(0))).count() == 0
