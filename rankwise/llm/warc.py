"""WARC derivatives: linked metadata and plain-text conversion records.

``responses`` puts fetched pages into response records: an HTTP header and the
page. ``derive`` makes of each response a conversion record with the visible text
of the page and a metadata record with what was known of the source: its HTTP
headers, digests, title, language and links. Both refer to the response
(WARC-Refers-To, with its address and date) and to each other
(WARC-Concurrent-To). Record identifiers are names of what a record is made
from, so a task that runs again gives the same records.

``write`` makes WARC files of records and ``read`` takes files apart again.
"""
from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwise.llm.html_blocks import blocks
from rankwise.llm.text import named

ROWS_AT_ONCE = 64
FETCHED = "2024-01-01T00:00:00Z"       # for pages without a date of their own
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivatives")
CRLF = "\r\n"
RECORD = ("source_id {id}, record_type string, record_id string, refers_to string, "
          "concurrent_to string, target_uri string, date string, content_type string, "
          "content_length long, block_digest string, source_digest string, block string")
TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
LANGUAGE = re.compile(r"<html[^>]*\slang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
LINK = re.compile(r"<a\s[^>]*?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def record_name(*parts) -> str:
    """A record identifier, the same for the same parts."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join('' if p is None else str(p) for p in parts))}>"


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def one_line(text: str | None) -> str:
    """A header value: no line breaks or other white space but single spaces."""
    return " ".join((text or "").split())


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _schema(id_type: pa.DataType) -> pa.Schema:
    strings = ["record_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date",
               "content_type"]
    return pa.schema([("source_id", id_type), *((n, pa.string()) for n in strings),
                      ("content_length", pa.int64()), ("block_digest", pa.string()),
                      ("source_digest", pa.string()), ("block", pa.string())])


def _record(source_id, kind, record_id, refers, beside, uri, date, media, block, source_digest):
    data = block.encode()
    return {"source_id": source_id, "record_type": kind, "record_id": record_id,
            "refers_to": refers, "concurrent_to": beside, "target_uri": uri, "date": date,
            "content_type": media, "content_length": len(data), "block_digest": sha1(data),
            "source_digest": source_digest, "block": block}


def response(source_id, uri: str | None, page: str | None, date: str) -> dict:
    """A response record: HTTP header and page. ``source_digest`` is the page's."""
    body = page or ""
    size = len(body.encode())
    head = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8",
                      f"Content-Length: {size}", "", ""])
    return _record(source_id, "response", record_name("response", source_id, uri), None, None,
                   uri and one_line(uri), date, "application/http; msgtype=response",
                   head + body, sha1(body.encode()))


def http_parts(block: str) -> tuple[list[tuple[str, str]], str]:
    """Header fields and body of a response block; no header without its blank line."""
    head, gap, body = block.partition(CRLF + CRLF)
    if not gap or not head.startswith("HTTP/"):
        return [], block
    fields = [line.partition(":") for line in head.split(CRLF)[1:]]
    return [(n.strip(), v.strip()) for n, _, v in fields if n.strip()], body


def derived(source: dict) -> list[dict]:
    """Conversion and metadata record of a response."""
    fields, page = http_parts(source["block"] or "")
    refers, uri, date = source["record_id"], source["target_uri"], source["date"]
    digest = source["source_digest"] or sha1(page.encode())
    names = [record_name(kind, refers) for kind in ("conversion", "metadata")]
    text = "\n".join(b.text for b in blocks(page))
    about = [("source-block-digest", source["block_digest"]), ("source-payload-digest", digest)]
    about += [(f"source-http-{name.lower()}", value) for name, value in fields]
    if m := TITLE.search(page):
        about.append(("title", one_line(html.unescape(m[1]))))
    if m := LANGUAGE.search(page):
        about.append(("language", m[1]))
    about += [("outlink", one_line(html.unescape(m[1] or m[2] or m[3] or "")))
              for m in LINK.finditer(page)]
    about = "".join(f"{k}: {v}{CRLF}" for k, v in about)
    return [_record(source["source_id"], "conversion", names[0], refers, names[1], uri, date,
                    "text/plain; charset=utf-8", text, digest),
            _record(source["source_id"], "metadata", names[1], refers, names[0], uri, date,
                    "application/warc-fields", about, digest)]


def _rows(batch: pa.RecordBatch) -> Iterator[list[dict]]:
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(at, ROWS_AT_ONCE).to_pylist()


def responses(pages: DataFrame, *, page_id: str = "page_id", url: str = "url",
              source: str = "html", date: str = FETCHED) -> DataFrame:
    """Response records of fetched pages, one a row, with ``source_id``.

    A null page is an empty one, a null address gives no target. Repeated rows
    give records of one name. Other columns are not read.
    """
    rows = pages.select(named(page_id).alias("id"), named(url).alias("url"),
                        named(source).alias("page"))
    kind = rows.schema["id"].dataType.simpleString()

    def made(batches):
        for batch in batches:
            schema = _schema(batch.schema.field("id").type)
            for part in _rows(batch):
                yield _batch([response(r["id"], r["url"], r["page"], date) for r in part], schema)
    return rows.mapInArrow(made, RECORD.format(id=kind))


def derive(records: DataFrame) -> DataFrame:
    """Two derivative records for each response; records of other types give none."""
    kind = records.schema["source_id"].dataType.simpleString()

    def made(batches):
        for batch in batches:
            schema = _schema(batch.schema.field("source_id").type)
            for part in _rows(batch):
                yield _batch([d for r in part for d in derived(r)], schema)
    return records.filter("record_type = 'response'") \
        .select("source_id", "record_type", "record_id", "refers_to", "concurrent_to", "target_uri",
                "date", "content_type", "content_length", "block_digest", "source_digest", "block") \
        .mapInArrow(made, RECORD.format(id=kind))


def serialised() -> Column:
    """A record as it stands in a file, without the two line breaks after it."""
    def line(name: str, value: str | Column) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return F.when(value.isNull(), "").otherwise(
            F.concat(F.lit(name + ": "), value.cast("string"), F.lit(CRLF)))
    refers = F.col("refers_to").isNotNull()
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", "record_type"),
        line("WARC-Record-ID", "record_id"), line("WARC-Date", "date"),
        line("WARC-Target-URI", "target_uri"), line("WARC-Refers-To", "refers_to"),
        line("WARC-Refers-To-Target-URI", F.when(refers, F.col("target_uri"))),
        line("WARC-Refers-To-Date", F.when(refers, F.col("date"))),
        line("WARC-Concurrent-To", "concurrent_to"),
        line("WARC-Block-Digest", "block_digest"),
        line("WARC-Payload-Digest", F.when(~refers, F.col("source_digest"))),
        line("WARC-Source-Digest", F.when(refers, F.col("source_digest"))),
        line("Content-Type", "content_type"), line("Content-Length", "content_length"),
        F.lit(CRLF), F.col("block"))


def write(records: DataFrame, path: str, *, records_per_file: int = 100_000,
          compression: str = "gzip") -> None:
    """Records as WARC files. The text sink ends each value with the two line
    breaks that end a record, so tasks write files without a format of their own."""
    records.select(serialised().alias("value")).write.option("lineSep", CRLF * 2) \
        .option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path)


def parse(data: bytes) -> Iterator[dict]:
    """Header fields and block of each record of a file, by Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode().split(CRLF)
        fields = dict(line.split(": ", 1) for line in head[1:])
        start, size = end + 4, int(fields["Content-Length"])
        yield fields | {"block": data[start:start + size].decode()}
        at = start + size + 4


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, a file at a time (``records_per_file`` bounds them)."""
    import gzip
    names = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID",
             "refers_to": "WARC-Refers-To", "concurrent_to": "WARC-Concurrent-To",
             "target_uri": "WARC-Target-URI", "date": "WARC-Date", "content_type": "Content-Type",
             "block_digest": "WARC-Block-Digest", "block": "block"}

    def taken(batches):
        schema = pa.schema([*((n, pa.string()) for n in names), ("content_length", pa.int64()),
                            ("source_digest", pa.string())])
        for batch in batches:
            for data in batch.column("content"):
                data = data.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows = []
                for f in parse(data):
                    rows.append({n: f.get(k) for n, k in names.items()} | {
                        "content_length": int(f["Content-Length"]),
                        "source_digest": f.get("WARC-Source-Digest") or f.get("WARC-Payload-Digest")})
                    if len(rows) == ROWS_AT_ONCE:
                        yield _batch(rows, schema)
                        rows = []
                yield _batch(rows, schema)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(taken, ", ".join(f"{n} string" for n in names)
                            + ", content_length long, source_digest string")
