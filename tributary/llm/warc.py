"""WARC: response records, and records derived from them.

A record is the bytes of one WARC/1.1 record without the two line ends after it. :func:`derived` reads
response records and makes of each a metadata record (status, source headers, title, links) and a
conversion record (visible text of a page). Both refer to the response by ``WARC-Refers-To`` and keep
its target, its date and the digest of its payload; they carry digests of their own. Identifiers are
made from the content, so a task that runs twice makes the same records.

Files are written by Spark's text writer, whose line end is the end of a record, and read by the length
that each record states; a file may be gzipped, also member by member.

Null pages are empty responses, null addresses empty targets. Records that are no responses are passed
over by :func:`derived`; bytes that are no record raise. Repeated pages give equal records.
"""

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from html import unescape
from io import BytesIO
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.html_dom import attributes, events, plain_text

VERSION = "WARC/1.1"
LINE, RECORD_END = b"\r\n", "\r\n\r\n"
HTTP = "application/http; msgtype=response"
DATE = "2024-01-01T00:00:00Z"  # of pages that state none
HTML = ("text/html", "application/xhtml+xml")

Headers = list[tuple[str, str]]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def _line_safe(text: str) -> str:
    return " ".join(text.split())


def build(headers: Headers, block: bytes) -> bytes:
    """A record; its length and the digest of its block are added."""
    lines = [VERSION, *(f"{name}: {value}" for name, value in headers), f"WARC-Block-Digest: {digest(block)}", f"Content-Length: {len(block)}"]
    return LINE.join(x.encode("utf-8", "surrogatepass") for x in lines) + LINE * 2 + block


def fields(lines: bytes) -> Headers:
    """Named fields; a line that starts with a blank continues the one before."""
    out: Headers = []
    for line in lines.split(LINE):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        elif ":" in text:
            name, _, value = text.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def value(headers: Headers, name: str) -> str | None:
    return next((v for n, v in headers if n.lower() == name.lower()), None)


def split(record: bytes) -> tuple[Headers, bytes]:
    """Headers and block of a record."""
    head, end, rest = record.partition(LINE * 2)
    if not head.startswith(b"WARC/") or not end:
        raise ValueError("not a WARC record")
    headers = fields(head.split(LINE, 1)[1] if LINE in head else b"")
    length = int(value(headers, "Content-Length") or -1)
    if not 0 <= length <= len(rest):
        raise ValueError("a WARC record is shorter than it states")
    return headers, rest[:length]


def response(url: str, html: str, date: str = DATE) -> bytes:
    payload = html.encode("utf-8", "surrogatepass")
    block = LINE.join([
        b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}".encode(), b"", payload])
    url = _line_safe(url)
    return build([
        ("WARC-Type", "response"), ("WARC-Record-ID", identifier("response", url, digest(payload))), ("WARC-Date", date),
        ("WARC-Target-URI", url), ("WARC-Payload-Digest", digest(payload)), ("Content-Type", HTTP),
    ], block)


def http(block: bytes) -> tuple[str, Headers, bytes]:
    """Status line, headers and payload of a response."""
    head, _, payload = block.partition(LINE * 2)
    status, _, lines = head.partition(LINE)
    return status.decode("utf-8", "replace"), fields(lines), payload


def _decoded(payload: bytes, kind: str) -> str:
    for part in kind.split(";")[1:]:
        name, _, charset = part.partition("=")
        if name.strip().lower() == "charset":
            try:
                return payload.decode(charset.strip(" \"'"), "replace")
            except LookupError:
                break
    return payload.decode("utf-8", "replace")


def _title_and_links(html: str, base: str) -> tuple[str, list[str]]:
    title, links, inside = "", [], False
    for kind, name, raw in events(html):
        if kind == "open" and name == "title" and not title:
            inside = True
        elif kind == "text" and inside:
            title += name
        elif kind == "close" and name == "title":
            inside = False
        elif kind == "open" and name in ("a", "area") and (href := attributes(raw).get("href")):
            try:
                links.append(_line_safe(urljoin(base, href)))
            except ValueError:
                links.append(_line_safe(href))
    return _line_safe(unescape(title)), links


def derivatives(record: bytes) -> list[bytes]:
    """Metadata and conversion of a response record; nothing of other records."""
    headers, block = split(record)
    if value(headers, "WARC-Type") != "response":
        return []
    status, source, payload = http(block)
    url, date, of = (value(headers, n) or "" for n in ("WARC-Target-URI", "WARC-Date", "WARC-Record-ID"))
    seen = value(headers, "WARC-Payload-Digest") or digest(payload)
    kind = value(source, "Content-Type") or ""
    is_html = kind.split(";")[0].strip().lower() in HTML
    html = _decoded(payload, kind) if is_html else ""
    title, links = _title_and_links(html, url)
    text = plain_text(html).encode("utf-8", "surrogatepass") if is_html else b""
    linked = [("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Refers-To", of), ("WARC-Refers-To-Payload-Digest", seen)]
    conversion_id, metadata_id = identifier("conversion", of, digest(text)), identifier("metadata", of, seen)
    about = [("status", status), *((f"source-{n.lower()}", v) for n, v in source), ("payload-length", str(len(payload))),
             ("payload-digest", seen), ("payload-digest-matches", str(seen == digest(payload)).lower()), ("title", title),
             *(("outlink", x) for x in links)]
    body = LINE.join(f"{n}: {v}".encode("utf-8", "surrogatepass") for n, v in about) + LINE
    out = [build([
        ("WARC-Type", "metadata"), ("WARC-Record-ID", metadata_id), *linked,
        *([("WARC-Concurrent-To", conversion_id)] if is_html else []), ("Content-Type", "application/warc-fields")], body)]
    if is_html:
        out.append(build([
            ("WARC-Type", "conversion"), ("WARC-Record-ID", conversion_id), *linked, ("WARC-Concurrent-To", metadata_id),
            ("WARC-Payload-Digest", digest(text)), ("Content-Type", "text/plain; charset=utf-8")], text))
    return out


def responses(pages: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """``page_id, record``: a response record of each page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = [response(u.as_py() or "", h.as_py() or "") for u, h in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(records, pa.binary())], ["page_id", "record"])

    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html")).mapInArrow(run, "page_id long, record binary")


def derived(records: DataFrame, id_col: str = "page_id", record_col: str = "record") -> DataFrame:
    """``page_id, record``: the records derived from the response records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, r) for i, record in zip(batch.column(0).to_pylist(), batch.column(1)) for r in derivatives(record.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in out], pa.int64()), pa.array([r for _, r in out], pa.binary())], ["page_id", "record"])

    return records.select(F.col(id_col).cast("long").alias("page_id"), F.col(record_col).alias("record")).mapInArrow(
        run, "page_id long, record binary")


INDEX = ("type", "record_id", "refers_to", "concurrent_to", "url", "date", "content_type", "refers_to_payload_digest", "payload_digest", "block_digest")
_HEADERS = ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Concurrent-To", "WARC-Target-URI", "WARC-Date", "Content-Type",
            "WARC-Refers-To-Payload-Digest", "WARC-Payload-Digest", "WARC-Block-Digest")


def described(records: DataFrame) -> DataFrame:
    """Headers, length and a digest of each record: ``page_id`` and the columns of the index."""
    names = ["page_id", *INDEX, "content_length", "record_sha256", "block_intact"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in names[1:]]
            for record in batch.column(1):
                raw = record.as_py()
                headers, block = split(raw)
                row = (*(value(headers, n) for n in _HEADERS), len(block), hashlib.sha256(raw).hexdigest(),
                       value(headers, "WARC-Block-Digest") == digest(block))
                for column, item in zip(columns, row):
                    column.append(item)
            kinds = [pa.string()] * len(INDEX) + [pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    schema = "page_id long, " + ", ".join(f"{n} string" for n in INDEX) + ", content_length long, record_sha256 string, block_intact boolean"
    return records.select("page_id", "record").mapInArrow(run, schema)


def write(records: DataFrame, path: str, per_file: int = 100_000, compression: str = "gzip") -> None:
    """WARC files of at most ``per_file`` records. Finished files appear at once, also if tasks run twice."""
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", RECORD_END).option(
        "maxRecordsPerFile", per_file).option("compression", compression).text(path)


def records_in(data: bytes) -> Iterator[bytes]:
    """The records of a file."""
    stream = BytesIO(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    while line := stream.readline():
        if not line.strip():
            continue
        head = [line]
        while (line := stream.readline()).strip():
            head.append(line)
        lines = b"".join(head)
        length = int(value(fields(lines), "Content-Length") or -1)
        block = stream.read(length) if length >= 0 else b""
        if length < 0 or len(block) < length:
            raise ValueError("a WARC file ends within a record")
        yield lines + LINE + block


def read(spark: SparkSession, path: str) -> DataFrame:
    """``record`` of every record of the files below a path; a file is read by one task (see ``per_file``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                some, size = [], 0
                for record in records_in(data.as_py()):
                    some.append(record)
                    size += len(record)
                    if size > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], ["record"])
                        some, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], ["record"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "record binary")


def report(pages: DataFrame) -> DataFrame:
    """Two rows per page: what the metadata and conversion records derived from its response say."""
    return described(derived(responses(pages)))
