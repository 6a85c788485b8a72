"""WARC derivatives: linked metadata and plain-text conversion records of responses.

Records are built and read as bytes, one row each: a response is read on its own, so the
builder is a single pass without a shuffle, and a table of records of any size becomes files by
writing its ``record`` column. Every derivative names its source in WARC-Refers-To, keeps the
source's other header fields, and carries digests of its own.

Header fields are lists in their order: names are read without case, repeated ones all count.
Bodies are decoded as their transfer and content encodings say before they are read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystar.llm.common import record, rows_of, slices
from keystar.llm.html_text import ATTRIBUTE, MARKUP

# Names of the record format.
VERSION = "WARC/1.1"
RESPONSE_TYPE = "application/http;msgtype=response"
#: Fields that a derivative has of its own; all others of its source are kept.
OWN = frozenset(
    "warc-type warc-record-id warc-refers-to warc-concurrent-to warc-payload-digest "
    "warc-block-digest warc-source-payload-digest content-type content-length".split()
)
#: Elements whose text is not shown, and elements that end a line.
UNSHOWN = frozenset("script style noscript template".split())
BREAKS = frozenset(
    "address article aside blockquote br dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr li main nav ol p pre section table td th title tr ul".split()
)
#: Bytes of a chunk of a body that is sent in chunks.
CHUNK = 4096
#: Bytes that a compressed body may grow to.
INFLATED = 1 << 28
EPOCH = "1970-01-01T00:00:00Z"

RECORDS = "source_id long, kind string, record_id string, refers_to string, record binary"



Fields = list[tuple[str, str]]


def first_of(fields: Fields, name: str, default: str | None = None) -> str | None:
    """The first value of a header field; names have no case."""
    return next((v for k, v in fields if k.lower() == name.lower()), default)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*names: str) -> str:
    """A stable record id: the same input gives the same records again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(names))}>"


def build_record(fields: Fields, block: bytes) -> bytes:
    """A record; line breaks in a value become spaces, and its length comes last."""
    lines = [VERSION]
    lines += [f"{name}: {' '.join(value.split())}" for name, value in fields]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _fields(lines: list[str]) -> Fields:
    """Names and values in order; a line that starts with white space goes on with the last."""
    fields: Fields = []
    for line in lines:
        name, found, value = line.partition(":")
        if line[:1] in (" ", "\t") and fields:
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
        elif found:
            fields.append((name.strip(), value.strip()))
    return fields


def parse_record(raw: bytes) -> tuple[Fields, bytes]:
    """Header fields and block of a record; ValueError if it is not one or is cut short."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/") or not found:
        raise ValueError("not a WARC record")
    fields = _fields(lines)
    size = int(first_of(fields, "Content-Length", "-1"))
    if size < 0 or len(rest) < size:
        raise ValueError("record is cut short")
    return fields, rest[:size]


def http_parts(block: bytes) -> tuple[str, Fields, bytes]:
    """Status line, headers and body of an HTTP response, the body as it was sent."""
    head, _, body = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split("\r\n")
    return first, _fields(lines), body


def _unchunked(body: bytes) -> bytes:
    """A chunked body put together; ValueError if it is not chunked to its end."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without a size")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        if size == 0:
            return b"".join(parts)
        at = end + 2
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        parts.append(body[at : at + size])
        at += size + 2


def _inflated(body: bytes, coding: str) -> bytes:
    """A gzip body of any number of members, or a deflate body with or without its header."""
    parts, size = [], 0
    bits = 31 if coding.endswith("gzip") else 15 if body[:1] == b"\x78" else -15
    while body:
        reader = zlib.decompressobj(bits)
        parts.append(reader.decompress(body, INFLATED + 1 - size))
        size += len(parts[-1])
        if size > INFLATED or not reader.eof:
            raise ValueError("body is cut short or grows beyond its bound")
        body = reader.unused_data if bits == 31 else b""
    return b"".join(parts)


def decoded_body(headers: Fields, body: bytes) -> tuple[bytes, bool]:
    """The body without its transfer and content encodings, and whether all were taken off.

    What cannot be decoded (an unknown coding, broken data, over INFLATED bytes) stays as it is.
    Harvesters often store bodies already decoded: one that is not chunked, or has no gzip
    mark, is taken as it is.
    """
    def codings(name: str) -> list[str]:
        values = ",".join(v for k, v in headers if k.lower() == name)
        return [x for x in (v.strip().lower() for v in values.split(",")) if x]

    for coding in reversed(codings("content-encoding") + codings("transfer-encoding")):
        try:
            if coding == "chunked":
                body = _unchunked(body)
            elif coding.endswith("gzip") and not body.startswith(b"\x1f\x8b"):
                continue
            elif coding in ("gzip", "x-gzip", "deflate"):
                body = _inflated(body, coding)
            elif coding != "identity":
                return body, False
        except (ValueError, zlib.error):
            if coding != "chunked":
                return body, False
    return body, True


def read_page(page: str) -> tuple[str, str | None, str | None, list[str]]:
    """Visible text (a line per block, white space folded), title, language and links.

    One scan over the markup from start to end.
    """
    parts, title, links = [], None, []
    language: str | None = None
    at, opened, named = 0, None, None
    while found := MARKUP.search(page, at):
        if opened is None:
            parts.append(page[at : found.start()])
        at = found.end()
        tag, ends = (found[1] or found[2] or "").lower(), bool(found[1])
        if opened is not None:
            opened = None if ends and tag == opened else opened
            continue
        if not tag:
            parts.append(" " if found[0].startswith("<!--") else "")
            continue
        if tag in UNSHOWN and not ends:
            parts.append(" ")
            opened = tag
            if tag in ("script", "style"):
                # Their text is no markup: only their own end tag ends them.
                close = _raw_end(tag).search(page, at)
                at, opened = (close.end() if close else len(page)), None
            continue
        if tag in BREAKS:
            parts.append("\n")
        if tag == "title":
            if ends and named is not None and title is None:
                title = "".join(parts[named:])
            named = None if ends else len(parts)
        if ends or tag not in ("a", "html"):
            continue
        values = {k.lower(): v.strip("\"'") for k, v in reversed(ATTRIBUTE.findall(found[3]))}
        if tag == "a" and "href" in values:
            links.append(html.unescape(values["href"]))
        elif tag == "html" and language is None and values.get("lang"):
            language = values["lang"].lower()
    if opened is None:
        parts.append(page[at:])
    return _folded("".join(parts)), None if title is None else _folded(title), language, links


def _raw_end(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)


def _folded(text: str) -> str:
    lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def response(
    source: int | None,
    url: str | None,
    page: str | None,
    date: str,
    headers: Fields | None = None,
    fields: Fields | None = None,
) -> tuple:
    """The response record of a stored page.

    ``headers`` and ``fields`` are further lines of the HTTP and of the record's header; a page
    whose headers say chunked or gzip is sent that way.
    """
    plain = (page or "").encode()
    body, extra = plain, list(headers or [])
    if "gzip" in (first_of(extra, "Content-Encoding") or "").lower():
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        body = packer.compress(body) + packer.flush()
    if "chunked" in (first_of(extra, "Transfer-Encoding") or "").lower():
        cut = [body[i : i + CHUNK] for i in range(0, len(body), CHUNK)] + [b""]
        body = b"".join(b"%x\r\n%s\r\n" % (len(x), x) for x in cut)
    else:
        extra.append(("Content-Length", str(len(body))))
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    lines += [f"{name}: {value}" for name, value in extra]
    block = "\r\n".join([*lines, "", ""]).encode() + body
    own = record_id("response", str(source), url or "", date)
    given = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", own),
        ("WARC-Date", date),
        ("WARC-Target-URI", url or ""),
        *(fields or []),
        ("WARC-Payload-Digest", digest(body)),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", RESPONSE_TYPE),
    ]
    return source, "response", own, None, build_record(given, block)


def _matches(stated: str | None, block: bytes) -> bool | None:
    """Whether a stated digest is that of the block; None if there is none or it is of a kind
    that is not known here."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() not in ("sha1", "sha256", "md5"):
        return None
    found = hashlib.new(kind.lower(), block).digest()
    if len(value) == 2 * len(found):
        return value.lower() == found.hex()
    return value.upper() == base64.b32encode(found).decode()


def derivatives(source: int | None, raw: bytes) -> Iterator[tuple]:
    """The metadata and the conversion record of a response."""
    fields, block = parse_record(raw)
    if (first_of(fields, "WARC-Type") or "").lower() != "response":
        return
    status, headers, sent = http_parts(block)
    body, decoded = decoded_body(headers, sent)
    found = re.search(r"charset\s*=\s*[\"']?([\w-]+)", first_of(headers, "content-type", ""), re.I)
    try:
        page = body.decode(found[1] if found else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    text, title, language, links = read_page(page if decoded else "")
    origin, payload = first_of(fields, "WARC-Record-ID", ""), digest(sent)
    stated = first_of(fields, "WARC-Payload-Digest")
    kept = [(k, v) for k, v in fields if k.lower() not in OWN]
    facts = {
        "status": status,
        "headers": headers,
        "title": title,
        "language": language,
        "links": links,
        "body_decoded": decoded,
        "payload_digest": payload,
        # Writers digest the payload as it was sent or without its encodings.
        "payload_digest_matches": stated == payload
        or _matches(stated, sent)
        or _matches(stated, body),
        "block_digest_matches": _matches(first_of(fields, "WARC-Block-Digest"), block),
        "source_fields": fields,
    }
    told = json.dumps(facts, ensure_ascii=False, sort_keys=True).encode("utf-8", "replace")
    bodies = {
        "metadata": (told, "application/json"),
        "conversion": (text.encode("utf-8", "replace"), "text/plain; charset=utf-8"),
    }
    made = {kind: record_id(kind, origin, payload) for kind in bodies}
    for kind, (content, content_type) in bodies.items():
        other = made["conversion" if kind == "metadata" else "metadata"]
        own = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", made[kind]),
            ("WARC-Refers-To", origin),
            ("WARC-Concurrent-To", other),
            *kept,
            ("WARC-Source-Payload-Digest", payload),
            ("WARC-Block-Digest", digest(content)),
            ("Content-Type", content_type),
        ]
        yield source, kind, made[kind], origin, build_record(own, content)


def responses(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    markup: str = "html",
    date: Column | None = None,
    headers: Column | None = None,
    fields: Column | None = None,
) -> DataFrame:
    """Response records (see ``RECORDS``) of stored pages; ``date`` as in WARC-Date.

    ``headers`` and ``fields`` are arrays of (name, value) structs: further lines of the HTTP
    and of the record's header. Null urls and pages count as empty, null ids stay null, repeated
    rows give equal records.
    """
    when = F.lit(EPOCH) if date is None else F.coalesce(date, F.lit(EPOCH))
    none = F.array().cast("array<struct<name: string, value: string>>")
    lines = [none if x is None else F.coalesce(x, none) for x in (headers, fields)]
    given = F.col(key).cast("long"), F.col(url), F.col(markup), when, *lines
    rows = pages.select(*(c.alias(f"c{i}") for i, c in enumerate(given)))

    def built(source, address, page, at, *extra) -> tuple:  # noqa: ANN001, ANN002
        pairs = [[(x["name"], x["value"]) for x in given] for given in extra]
        return response(source, address, page, at, *pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            yield record(RECORDS, [built(*row) for row in rows_of(batch)])

    return rows.mapInArrow(run, RECORDS)


def derive(records: DataFrame) -> DataFrame:
    """Derivative records of the responses among ``records`` (columns source_id, record).

    Two rows per response, in the shape of ``RECORDS``. Other record types have none. A null
    record has none either; bytes that are not a whole record give one row of kind
    ``unreadable`` with the bytes as they are, so nothing is lost silently.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            out: list[tuple] = []
            for source, raw in rows_of(batch):
                if raw is None:
                    continue
                try:
                    out.extend(derivatives(source, raw))
                except ValueError:
                    out.append((source, "unreadable", None, None, raw))
            yield record(RECORDS, out)

    return records.select("source_id", "record").mapInArrow(run, RECORDS)


def described(records: DataFrame) -> DataFrame:
    """Fields read back from records: one row each, without the bytes.

    ``source_fields`` holds every field that came from the source, in order, a line each.
    ``http_headers`` (metadata records) holds the source's HTTP headers likewise.
    """
    schema = (
        "source_id long, kind string, record_id string, refers_to string, target_uri string, "
        "source_payload_digest string, block_digest string, block_ok boolean, block_bytes long, "
        "block_sha256 string, source_fields string, http_headers string"
    )

    def lines(fields: Fields) -> str:
        return "\n".join(f"{k}: {v}" for k, v in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            out = []
            for source, kind, raw in rows_of(batch):
                if kind == "unreadable":
                    out.append((source, kind, *[None] * 5, False, len(raw), *[None] * 3))
                    continue
                fields, block = parse_record(raw)
                told = kind == "metadata"
                out.append(
                    (
                        source,
                        first_of(fields, "WARC-Type"),
                        first_of(fields, "WARC-Record-ID"),
                        first_of(fields, "WARC-Refers-To"),
                        first_of(fields, "WARC-Target-URI"),
                        first_of(fields, "WARC-Source-Payload-Digest"),
                        first_of(fields, "WARC-Block-Digest"),
                        _matches(first_of(fields, "WARC-Block-Digest"), block),
                        len(block),
                        hashlib.sha256(block).hexdigest(),
                        lines([x for x in fields if x[0].lower() not in OWN]),
                        lines(json.loads(block)["headers"]) if told else None,
                    )
                )
            yield record(schema, out)

    return records.select("source_id", "kind", "record").mapInArrow(run, schema)


def gzip_members(records: DataFrame) -> DataFrame:
    """``record`` as a gzip member of its own: concatenated members are a .warc.gz file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            out = []
            for row in rows_of(batch):
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = row[-1] or b""
                out.append((*row[:-1], packer.compress(raw) + packer.flush()))
            yield record(RECORDS, out)

    return records.select("source_id", "kind", "record_id", "refers_to", "record").mapInArrow(
        run, RECORDS
    )
