"""WARC derivatives: a metadata and a plain-text conversion record for each response record.

Both name the response they derive from (WARC-Refers-To, its URI and date) and each other;
the metadata record keeps the HTTP status and headers and the digests of the source. Records
are built where responses are read, without a shuffle.
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

VERSION = "WARC/1.1"
#: The pages carry no time of capture; records need one.
CAPTURED = "2024-01-01T00:00:00Z"

RECORD_SCHEMA = (
    "source_id string, type string, record_id string, refers_to string, concurrent_to string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, source_payload_digest string, "
    "source_headers array<struct<name:string,value:string>>, header string, block string"
)

#: The inside of a tag: a quoted value may hold any character, also angle brackets.
_VALUE = r"(?:(?<==)|(?<== ))"
_INSIDE = rf"(?>(?:[^<>\"']|{_VALUE}(?:\"[^\"]*\"|'[^']*')|(?<!=)(?<!= )[\"'])*)"
_SKIPPED = rf"<(script|style|noscript|template)\b{_INSIDE}>.*?(?:</\1\s*>|\Z)"
MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|{_SKIPPED}|</?([a-z][a-z0-9]*){_INSIDE}>|</?([a-z][a-z0-9]*)[^<>]*>|<[!?][^<>]*>", re.DOTALL | re.IGNORECASE
)
#: Elements that start a new line.
BREAKING = frozenset(
    "address article aside blockquote body br dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html "
    "li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
)


def html_text(markup: str) -> str:
    """Text of a page: markup, scripts, styles and comments go, blocks become lines, entities characters."""

    def replaced(match: re.Match) -> str:
        name = match.group(2) or match.group(3)
        return "\n" if name and name.lower() in BREAKING else ""

    stripped = html.unescape(MARKUP.sub(replaced, " ".join(markup.split())))
    lines = (" ".join(line.split()) for line in stripped.split("\n"))
    return "\n".join(line for line in lines if line)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def parse_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of an HTTP response; without a header part all is body."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not head.startswith(b"HTTP/"):
        return "", [], block
    lines = head.decode("latin-1").split("\r\n")
    pairs = (line.partition(":") for line in lines[1:] if ":" in line)
    return lines[0], [(name.strip(), value.strip()) for name, _, value in pairs], body if gap else b""


def _one_line(value: str) -> str:
    return " ".join(value.split())


def header_text(fields: list[tuple[str, str]]) -> str:
    return "".join([f"{VERSION}\r\n", *(f"{name}: {_one_line(value)}\r\n" for name, value in fields if value)])


def _decoded(body: bytes, content_type: str) -> str:
    found = re.search(r"charset=[\"']?([\w.:-]+)", content_type, re.IGNORECASE)
    try:
        return body.decode(found.group(1) if found else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def derivatives(record_id: str, uri: str, date: str, block: bytes) -> list[dict]:
    """The metadata record, and the conversion record if the payload is text, of one response."""
    status, headers, body = parse_http(block)
    by_name = {name.lower(): value for name, value in headers}
    content_type = by_name.get("content-type", "text/html")
    ids = {kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, record_id + kind)}>" for kind in ("metadata", "conversion")}
    payload_digest, source_digest = digest(body), digest(block)
    kind = content_type.split(";")[0].strip().lower()
    text = None
    if kind in ("text/html", "application/xhtml+xml", "text/plain"):
        text = _decoded(body, content_type)
        text = text if kind == "text/plain" else html_text(text)
    fields = [("source-status", status), ("source-block-digest", source_digest), ("source-payload-digest", payload_digest)]
    fields += [(f"source-header-{name}", value) for name, value in headers]
    fields += [("converted-to", ids["conversion"])] if text is not None else []
    metadata = "".join(f"{name}: {_one_line(value)}\r\n" for name, value in fields if value)
    blocks = [("metadata", "application/warc-fields", metadata)]
    if text is not None:
        blocks.append(("conversion", "text/plain; charset=utf-8", text))
    out = []
    for which, mime, content in blocks:
        raw = content.encode("utf-8", "replace")
        other = ids["conversion" if which == "metadata" else "metadata"] if text is not None else ""
        header = [
            ("WARC-Type", which),
            ("WARC-Record-ID", ids[which]),
            ("WARC-Date", date),
            ("WARC-Target-URI", uri),
            ("WARC-Refers-To", record_id),
            ("WARC-Refers-To-Target-URI", uri),
            ("WARC-Refers-To-Date", date),
            ("WARC-Concurrent-To", other),
            ("WARC-Block-Digest", digest(raw)),
            ("Content-Type", mime),
            ("Content-Length", str(len(raw))),
        ]
        out.append(
            {
                "type": which,
                "record_id": ids[which],
                "refers_to": record_id,
                "concurrent_to": other or None,
                "target_uri": uri,
                "date": date,
                "content_type": mime,
                "content_length": len(raw),
                "block_digest": digest(raw),
                "source_payload_digest": payload_digest,
                "source_headers": [{"name": n, "value": v} for n, v in headers],
                "header": header_text(header),
                "block": raw.decode(),
            }
        )
    return out


_STRINGS = ["source_id", "type", "record_id", "refers_to", "concurrent_to", "target_uri", "date", "content_type"]
_ARROW = pa.schema(
    [
        *((name, pa.string()) for name in _STRINGS),
        ("content_length", pa.int64()),
        ("block_digest", pa.string()),
        ("source_payload_digest", pa.string()),
        ("source_headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
        ("header", pa.string()),
        ("block", pa.string()),
    ]
)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            rows = []
            for row in batch.slice(start, 64).to_pylist():
                made = derivatives(row["record_id"], row["target_uri"] or "", row["date"] or CAPTURED, row["block"] or b"")
                rows.extend(record | {"source_id": row["source_id"]} for record in made)
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


def derive_records(responses: DataFrame) -> DataFrame:
    """Derivative records of every row of ``responses`` (source_id, record_id, target_uri, date, block).

    ``block`` is the HTTP response, bytes. A null block is empty; a null URI leaves its
    fields out; a block without HTTP headers is a page; a payload that is no text has a
    metadata record only; bytes that don't decode are replaced; repeated rows give repeated
    records. ``header`` and ``block`` of a result are the record as a WARC file has it.
    """
    inputs = responses.select(
        F.col("source_id").cast("string"), F.coalesce("record_id", F.lit("")).alias("record_id"), "target_uri", "date", F.col("block").cast("binary")
    )
    return inputs.mapInArrow(_build, RECORD_SCHEMA)


def responses_of(pages: DataFrame) -> DataFrame:
    """Response records of ``pages`` (page_id, url, html), as a crawler would have stored them."""
    body = F.coalesce("html", F.lit(""))
    digits = F.md5(F.concat_ws("\n", F.col("page_id").cast("string"), F.col("url")))
    cuts = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return pages.select(
        F.col("page_id").cast("string").alias("source_id"),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(CAPTURED).alias("date"),
        F.concat(head, body).cast("binary").alias("block"),
    )


def write_warc(records: DataFrame, folder: str) -> None:
    """``records`` as WARC files, one per task, in a folder Spark can write to."""
    whole = F.concat("header", F.lit("\r\n"), "block")
    records.select(whole.alias("value")).write.option("lineSep", "\r\n\r\n").text(folder)
