"""WARC derivatives: links, digests, odd records, gzip members."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import time
import zlib

import pyarrow.parquet as pq
import pytest

from keystar.llm import warc
from keystar.llm.queries import QUERIES
from tests.conftest import rows

PAGE = (
    "<html lang='EN'><head><title>T &amp; t</title><script>no()</script></head>"
    "<body><p>One<b> two</b></p><!-- x --><div>Three &lt;p&gt;<a href='/a?b=1&amp;c'>four</a></div>"
)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_derivatives_are_linked():
    raw = warc.response(7, "http://x/é", PAGE, "2024-01-02T03:04:05Z")[-1]
    source, block = warc.parse_record(raw)
    source = dict(source)
    made = {}
    for _, kind, own, to, r in warc.derivatives(7, raw):
        fields, content = warc.parse_record(r)
        made[kind] = own, to, (dict(fields), content)
    assert set(made) == {"metadata", "conversion"}
    for kind, (own, to, (fields, content)) in made.items():
        assert fields["WARC-Type"] == kind and fields["WARC-Record-ID"] == own
        assert fields["WARC-Refers-To"] == to == source["WARC-Record-ID"]
        assert fields["WARC-Target-URI"] == "http://x/é"
        assert fields["WARC-Date"] == "2024-01-02T03:04:05Z"
        assert fields["WARC-Source-Payload-Digest"] == sha1(PAGE.encode())
        assert fields["WARC-Block-Digest"] == sha1(content)
        assert int(fields["Content-Length"]) == len(content)
    assert made["metadata"][2][0]["WARC-Concurrent-To"] == made["conversion"][0]
    assert made["conversion"][2][1].decode() == "T & t\nOne two\nThree <p>four"
    facts = json.loads(made["metadata"][2][1])
    assert facts["title"] == "T & t" and facts["language"] == "en"
    assert facts["links"] == ["/a?b=1&c"] and facts["payload_digest_matches"]
    assert warc.http_parts(block)[0] == "HTTP/1.1 200 OK"


def test_broken_digest_is_told():
    raw = warc.response(1, "u", "abc", warc.EPOCH)[-1].replace(b"abc", b"abd")
    facts = json.loads(warc.parse_record(next(iter(warc.derivatives(1, raw)))[-1])[1])
    assert not facts["payload_digest_matches"] and not facts["block_digest_matches"]


@pytest.mark.parametrize("raw", [b"", b"x", b"WARC/1.0\r\nContent-Length: 9\r\n\r\nshort"])
def test_cut_records(raw):
    with pytest.raises(ValueError):
        warc.parse_record(raw)


def test_odd_rows(spark):
    pages = [
        (1, None, None, "k"), (1, None, None, "k"), (None, "u\r\nX: y", "", None),
        (2, "u", "p" * 200_000, "k"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, kind string")
    made = warc.responses(frame)
    got = warc.described(warc.derive(made))
    assert got.count() == 8
    assert got.where("NOT block_ok").count() == 0
    assert got.where("target_uri = 'u X: y'").count() == 2
    sizes = rows(got.where("kind = 'conversion'"), "source_id", "block_bytes")
    assert sizes == sorted([(1, 0), (1, 0), (None, 0), (2, 200_000)], key=repr)
    assert warc.derive(warc.derive(made)).count() == 0
    broken = spark.createDataFrame(
        [(5, bytearray(b"no record")), (6, None)], "source_id long, record binary"
    )
    assert rows(warc.derive(broken), "source_id", "kind") == [(5, "unreadable")]
    assert rows(warc.described(warc.derive(broken)), "kind", "block_ok") == [("unreadable", False)]
    assert warc.derive(warc.responses(frame.limit(0))).count() == 0
    members = b"".join(bytes(r.record) for r in warc.gzip_members(made).collect())
    assert gzip.decompress(members).count(b"WARC/1.1\r\n") == 4


HEAD = [
    ("WARC-TYPE", "response"), ("warc-record-id", "<urn:x>"), ("WARC-Date", "2024-01-02T03:04:05Z"),
    ("warc-target-uri", "http://x/"), ("WARC-Protocol", "a"), ("WARC-Protocol", "b"),
    ("WARC-Truncated", "length"), ("X-Own", "one: two"),
]


def derived(headers, body, head=HEAD):
    lines = ["HTTP/1.1 200 OK", *(f"{k}: {v}" for k, v in headers), "", ""]
    raw = warc.build_record(head, "\r\n".join(lines).encode() + body)
    made = {kind: warc.parse_record(r) for _, kind, _, _, r in warc.derivatives(1, raw)}
    return made, json.loads(made["metadata"][1]), made["conversion"][1].decode()


def test_all_headers_are_kept():
    headers = [["Set-Cookie", "a=1"], ["set-cookie", "b=2"], ["Server", "s"]]
    made, facts, text = derived(headers, b"<p>x</p>")
    assert facts["headers"] == headers and text == "x"
    assert facts["source_fields"][:-1] == [list(x) for x in HEAD]
    for fields, _ in made.values():
        assert [x for x in fields if x in HEAD] == HEAD[2:]
        assert warc.first_of(fields, "warc-refers-to") == "<urn:x>"
    folded = b"WARC/1.0\r\nA: b\r\n  c\r\ncontent-length: 0\r\n\r\n"
    assert warc.parse_record(folded)[0][0] == ("A", "b c")


def chunks(body, size=5):
    parts = [body[i : i + size] for i in range(0, len(body), size)] + [b""]
    return b"".join(b"%X;ext=1\r\n%s\r\n" % (len(p), p) for p in parts)


PLAIN = "<html><title>T</title><p>hello, wörld</p></html>".encode()
RAW_DEFLATE = zlib.compress(PLAIN)[2:-4]


@pytest.mark.parametrize(
    ("headers", "body", "decoded"),
    [
        ([], PLAIN, True),
        ([("Transfer-Encoding", "chunked")], chunks(PLAIN), True),
        ([("transfer-encoding", "Chunked"), ("content-encoding", "gzip")], chunks(gzip.compress(PLAIN)), True),
        ([("Transfer-Encoding", "gzip, chunked")], chunks(gzip.compress(PLAIN)), True),
        ([("Content-Encoding", "x-gzip")], gzip.compress(PLAIN[:9]) + gzip.compress(PLAIN[9:]), True),
        ([("Content-Encoding", "deflate")], zlib.compress(PLAIN), True),
        ([("Content-Encoding", "deflate")], RAW_DEFLATE, True),
        ([("Content-Encoding", "identity")], PLAIN, True),
        ([("Transfer-Encoding", "chunked"), ("Content-Encoding", "gzip")], PLAIN, True),
        ([("Content-Encoding", "br")], b"\x00\x01", False),
        ([("Content-Encoding", "gzip")], gzip.compress(PLAIN)[:-12], False),
    ],
)
def test_bodies_are_decoded(headers, body, decoded):
    _, facts, text = derived(headers, body)
    assert facts["body_decoded"] is decoded
    assert text == ("T\nhello, wörld" if decoded else "")
    digests = [("WARC-Payload-Digest", "sha256:" + hashlib.sha256(body).hexdigest())]
    assert derived(headers, body, HEAD + digests)[1]["payload_digest_matches"] is True
    assert facts["payload_digest_matches"] is None


@pytest.mark.parametrize(
    "page",
    ["<a " * 100_000, "<title>" * 100_000, "<a href='" * 50_000, "<noscript>" * 50_000,
     "<a x" * 50_000 + '"', "<!--" * 100_000, "<script>" * 50_000, "<a <b " * 50_000 + '"'],
)
def test_work_grows_with_the_page(page):
    start = time.process_time()
    warc.read_page(page)
    assert time.process_time() - start < 5


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {
        (r.source_id, r.kind): r for r in QUERIES["op9_warc_derivatives"](spark, sf).collect()
    }
    pages = pq.read_table(f"{sf}/pages.parquet").to_pylist()
    assert len(got) == 2 * len(pages)
    for page in pages:
        row, facts = got[page["page_id"], "conversion"], got[page["page_id"], "metadata"]
        assert row.target_uri == page["url"] and row.block_ok and facts.block_ok
        body, way = page["html"].encode(), page["page_id"] % 4
        headers = ["Content-Type: text/html; charset=utf-8", f"Set-Cookie: id={page['page_id']}",
                   "Set-Cookie: seen=1", "x-served-by: cache: a, b"]
        if way % 2:
            headers.append("transfer-encoding: chunked")
        if way >= 2:
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            body = packer.compress(body) + packer.flush()
            headers.append("Content-Encoding: gzip")
        if way % 2:
            parts = [body[i : i + 4096] for i in range(0, len(body), 4096)] + [b""]
            body = b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts)
        else:
            headers.append(f"Content-Length: {len(body)}")
        assert facts.http_headers.split("\n") == headers
        fields = ["WARC-Date: " + warc.EPOCH, f"WARC-Target-URI: {page['url']}",
                  "WARC-IP-Address: 192.0.2.7", "WARC-Protocol: http/1.1",
                  "warc-protocol: tls/1.3", "WARC-Truncated: length"]
        assert row.source_fields.split("\n") == facts.source_fields.split("\n") == fields
        assert row.source_payload_digest == facts.source_payload_digest == sha1(body)
        assert facts.refers_to == row.refers_to
        shown = re.sub(r"(?s)<!--.*?-->|<(script|style)>.*?</\1>", "", page["html"])
        shown = re.sub(r"</?(p|div|li|ul|nav|h1|title|article|footer|br)\b[^>]*>", "\n", shown)
        lines = html.unescape(re.sub(r"<[^>]*>", "", shown)).split("\n")
        text = "\n".join(t for t in (" ".join(x.split()) for x in lines) if t)
        assert row.block_sha256 == hashlib.sha256(text.encode()).hexdigest()
