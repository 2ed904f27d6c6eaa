"""WARC derivatives: linked metadata and plain-text conversion records for responses.

Each response record gives a ``metadata`` record (its HTTP status and headers,
title, links) and, where its payload is text, a ``conversion`` record with the
plain text. Both name the response by ``WARC-Refers-To``, keep its target URI
and date, and carry its payload digest and source headers beside the digests
of their own. Record ids follow from content, so a task that runs again
writes the same records. Records are mapped where they lie, one Arrow batch
at a time; nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import decode, map_batches, utf8

DATE = "1970-01-01T00:00:00Z"
_VERSION = b"WARC/1.1"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

_DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|"
    r"li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"<[/!?a-zA-Z][^>]*>")
_TITLE = re.compile(r"<title\b", re.I)
_TITLE_END = re.compile(r"</title\s*>", re.I)
_ANCHOR = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(31).join(parts))}>"


def build(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record's bytes: header lines, block, and the two line ends that close it."""
    lines = [f"{name}: {' '.join(value.split())}" for name, value in [*headers, ("Content-Length", str(len(block)))]]
    return b"\r\n".join([_VERSION, *(x.encode("utf-8", "replace") for x in lines), b"", block, b"", b""])


def _fields(head: bytes) -> list[tuple[str, str]]:
    """Header fields in order; lines that begin with blanks go on from the line before."""
    out: list[tuple[str, str]] = []
    for line in decode(head).replace("\r\n", "\n").split("\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def _head(data: bytes) -> tuple[bytes, bytes]:
    """What stands before and after the first empty line."""
    at = min((i, n) for i, n in ((data.find(b"\r\n\r\n"), 4), (data.find(b"\n\n"), 2), (len(data), 0)) if i >= 0)
    return data[: at[0]], data[at[0] + at[1] :]


def parse(record: bytes) -> tuple[dict[str, str], bytes] | None:
    """A record's header fields by lower-case name, and its block; None if it is no whole WARC record."""
    head, rest = _head(record)
    version, _, lines = head.partition(b"\n")
    fields = {name.lower(): value for name, value in reversed(_fields(lines))}
    length = fields.get("content-length", "")
    if not version.startswith(b"WARC/") or not length.isdigit() or int(length) > len(rest):
        return None
    return fields, rest[: int(length)]


def _without_tags(page: str, breaks: str | None = None) -> str:
    """``page`` without its tags; those of blocks become ``breaks``.

    A tag ends at the next ``>``. What follows the last one of the page holds
    no tag, so no opening is looked through to the page's end in vain.
    """
    end = page.rfind(">") + 1
    head = page[:end]
    if breaks is not None:
        head = _BREAK.sub(breaks, head)
        return _without_tags(head) + page[end:]
    return _TAG.sub("", head) + page[end:]


def title_of(page: str) -> str | None:
    """What stands between the first ``<title ...>`` that is closed, and its end tag."""
    opened = _TITLE.search(page)
    start = page.find(">", opened.end()) if opened else -1
    # Without an end tag after this opening there is none after a later one.
    closed = _TITLE_END.search(page, start + 1) if start >= 0 else None
    return page[start + 1 : closed.start()] if closed else None


def links_of(page: str) -> Iterator[str]:
    """The first ``href`` of each ``<a ...>``, in order; a quoted value may hold ``>``."""
    at = 0
    while anchor := _ANCHOR.search(page, at):
        end = page.find(">", anchor.end())
        end = len(page) if end < 0 else end
        at = end  # another opening before it has no other attributes
        for name in _HREF.finditer(page, anchor.end(), end):
            if value := _VALUE.match(page, name.end()):
                yield next(v for v in value.groups() if v is not None)
                at = value.end()
                break


def plain_text(page: str) -> str:
    """The text of an HTML page: a line for each block, blanks collapsed, without scripts, styles and comments."""
    bare = html.unescape(_without_tags(_DROP.sub(" ", page), "\n"))
    return "\n".join(line for line in (" ".join(x.split()) for x in bare.split("\n")) if line)


def _payload_text(kind: str, payload: bytes) -> str:
    charset = _CHARSET.search(kind)
    try:
        return payload.decode(charset[1] if charset else "utf-8", errors="replace")
    except LookupError:
        return decode(payload)


def derive(record: bytes) -> list[dict]:
    """The derivatives of a response record; none for other or broken records."""
    parsed = parse(record)
    if parsed is None or parsed[0].get("warc-type", "").lower() != "response":
        return []
    source, block = parsed
    head, payload = _head(block)
    status, _, lines = head.partition(b"\n")
    http = _fields(lines)
    kind = next((v for n, v in http if n.lower() == "content-type"), "")
    source_id = source.get("warc-record-id", "")
    payload_digest = source.get("warc-payload-digest") or digest(payload)
    page = _payload_text(kind, payload)
    is_html = "html" in kind.lower()
    fields = [("http-status", decode(status).strip()), *((f"http-header-{n.lower()}", v) for n, v in http), ("source-payload-digest", payload_digest)]
    if is_html:
        title = title_of(page)
        fields += [("title", " ".join(html.unescape(_without_tags(title)).split()))] if title is not None else []
        fields += [("outlink", " ".join(html.unescape(link).split())) for link in links_of(_DROP.sub(" ", page))]
    blocks = [("metadata", "application/warc-fields", "".join(f"{n}: {' '.join(v.split())}\r\n" for n, v in fields).encode("utf-8", "replace"))]
    if is_html or kind.lower().startswith("text/"):
        text = plain_text(page) if is_html else page
        blocks.append(("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")))
    out = []
    for record_type, content_type, data in blocks:
        own = {
            "record_type": record_type,
            "record_id": record_id(record_type, source_id, payload_digest),
            "refers_to": source_id,
            "target_uri": source.get("warc-target-uri", ""),
            "date": source.get("warc-date", ""),
            "source_payload_digest": payload_digest,
            "block_digest": digest(data),
            "source_headers": [{"name": n, "value": v} for n, v in http],
        }
        headers = [
            ("WARC-Type", record_type),
            ("WARC-Record-ID", own["record_id"]),
            ("WARC-Date", own["date"]),
            ("WARC-Target-URI", own["target_uri"]),
            ("WARC-Refers-To", source_id),
            ("WARC-Block-Digest", own["block_digest"]),
            ("WARC-Payload-Digest", own["block_digest"]),
            ("WARC-Source-Payload-Digest", payload_digest),
            ("Content-Type", content_type),
        ]
        out.append(own | {"block": data, "record": build([h for h in headers if h[1]], data)})
    return out


def response_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """``(id, record)``: each page as the WARC response record of a crawl at ``date``. Null urls and pages count as empty."""
    src = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), utf8(html_col).alias("page"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        records = []
        for name, url, page in zip(batch["id"].to_pylist(), batch["url"].to_pylist(), batch["page"].to_pylist()):
            block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n%b" % (len(page), page)
            payload = digest(page)
            headers = [
                ("WARC-Type", "response"),
                ("WARC-Record-ID", record_id("response", str(name), url, date, payload)),
                ("WARC-Date", date),
                ("WARC-Target-URI", url),
                ("WARC-Payload-Digest", payload),
                ("WARC-Block-Digest", digest(block)),
                ("Content-Type", "application/http; msgtype=response"),
            ]
            records.append(build([h for h in headers if h[1]], block))
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(records, pa.binary())], ["id", "record"])

    return map_batches(src, run, f"id {src.schema['id'].dataType.simpleString()}, record binary").withColumnRenamed("id", id_col)


def derivatives(responses: DataFrame, id_col: str = "page_id", record_col: str = "record") -> DataFrame:
    """The derivative records of each response, metadata first, as rows with their WARC bytes in ``record``.

    Columns: the id, ``record_type``, ``record_id``, ``refers_to``,
    ``target_uri``, ``date``, ``source_payload_digest``, ``block_digest``,
    ``source_headers``, ``block``, ``record``.

    Null, broken and other records than responses give no rows; a response
    with an empty page gives both records, the conversion's block empty; one
    that isn't text gives its metadata record only. Repeated responses give
    repeated rows with equal ids. An empty table gives an empty result.
    """
    src = responses.select(F.col(id_col).alias("strata_id"), F.coalesce(F.col(record_col), F.lit(b"")).alias("record"))
    strings = ("record_type", "record_id", "refers_to", "target_uri", "date", "source_payload_digest", "block_digest")
    headers = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        records = batch["record"]
        for at in range(0, len(records), 256):
            row, found = [], []
            for n, record in enumerate(records.slice(at, 256).to_pylist()):
                for d in derive(record):
                    row.append(at + n)
                    found.append(d)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["strata_id"].take(pa.array(row, pa.int64())),
                    *(pa.array([d[c] for d in found], pa.string()) for c in strings),
                    pa.array([d["source_headers"] for d in found], headers),
                    *(pa.array([d[c] for d in found], pa.binary()) for c in ("block", "record")),
                ],
                ["strata_id", *strings, "source_headers", "block", "record"],
            )

    schema = f"strata_id {src.schema['strata_id'].dataType.simpleString()}, " + ", ".join(f"{c} string" for c in strings)
    out = map_batches(src, run, f"{schema}, source_headers array<struct<name: string, value: string>>, block binary, record binary")
    return out.withColumnRenamed("strata_id", id_col)
