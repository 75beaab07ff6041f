"""WARC archives: writing captures, reading records, assembling transactions.

Writing (built-in functions only).  A page becomes three records: a request, a
response (or a revisit, which has no payload) and a metadata record whose block
holds the page's id.  Request and metadata name the response in
``WARC-Concurrent-To``.  Spark's text writer puts the records into archives of
one gzip stream each: its line separator is the blank line that ends a WARC
record, so the bytes are those of the format.

Of equal payloads of at least ``min_revisit`` bytes, that of the smallest id is
a response and the others are revisits of it (profile identical-payload-digest);
rows equal to the response in id and payload are responses too.  Who revisits
whom is found on (id, digest) rows; the payloads are shuffled once, by id and
digest, so that a group of copies does not meet in one task.

Reading.  Spark's text reader cuts the archives at blank lines, wherever they
are stored; a gzip stream is never split, so a task sees a file's pieces in
order and puts them together by ``Content-Length`` (blank lines or whole
records inside a payload are just bytes).  A task holds one record and one
Arrow batch at a time.  Length and SHA-256 of a payload are of the bytes read.

Assembling.  Requests and metadata are joined with their response through the
concurrent-to identifiers, in either direction, and each capture becomes one
nested row.  Of several requests (metadata records) of a capture, that with the
smallest record id is taken.  A request or metadata record that reaches no
response or revisit belongs to no capture.

Defined results: null payloads are empty; null urls have no target; control
characters and blanks in urls are percent-encoded; a null id is no smallest id,
and copies that only null ids have are all responses; repeated rows are captures
of their own; no rows give an archive without records; other columns are not
written.  A truncated archive is an error.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, type string, target_uri string, date string, concurrent_to array<string>, "
          "refers_to_uri string, profile string, content_type string, http_status int, http_headers map<string,string>, "
          "fields map<string,string>, payload_bytes bigint, payload_digest string, payload binary")


# -- writing --------------------------------------------------------------------

def _line(name: str, value: Column | str) -> Column:
    """``name: value``; null without a value."""
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value)


def _record(kind: str, record_id: Column, lines: list[Column], block: Column) -> Column:
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), _line("WARC-Type", kind), _line("WARC-Record-ID", record_id), *lines,
                       _line("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(head.cast("binary"), F.lit(END).cast("binary"), block)


def _safe_uri(url: Column) -> Column:
    """``url`` with blanks and control characters percent-encoded."""
    out = url
    for code in [*range(33), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike("[\\x00-\\x20\\x7F]"), out).otherwise(url)


def revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(id, digest, bytes, url) -> (r_id, r_digest, r_url): the rows that
    revisit an earlier payload, once each, and the url of its response."""
    big = pages.filter(F.col("bytes") >= min_bytes).groupBy("digest", "id").agg(F.min("url").alias("url"))
    first = (big.groupBy("digest").agg(F.min("id").alias("first"), F.min_by("url", "id").alias("r_url"), F.count(F.lit(1)).alias("ids"))
             .filter(F.col("ids") > 1).withColumnRenamed("digest", "r_digest"))
    return (big.join(first, F.col("digest") == F.col("r_digest"))
            .filter(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))
            .select(F.col("id").alias("r_id"), "r_digest", "r_url"))


def records_of(pages: DataFrame, id_col: str, url_col: str, payload_col: str, date: str, min_revisit: int) -> DataFrame:
    """One binary column ``record``: three records per page."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    p = pages.select(F.col(id_col).alias("id"), _safe_uri(F.col(url_col)).alias("url"), payload.alias("payload"))
    p = p.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    found = revisits(p.select("id", "url", "digest", "bytes"), min_revisit)
    j = p.join(found, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    ids = {c: F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")) for c in ("q", "r", "m")}
    j = j.select("*", *[v.alias(k) for k, v in ids.items()])
    target, when = _line("WARC-Target-URI", F.col("url")), _line("WARC-Date", date)
    host = F.regexp_extract("url", r"^[^/?#]*://([^/?#]*)", 1)
    path = F.regexp_extract("url", r"^[^/?#]*://[^/?#]*([^#]*)", 1)
    get = F.concat(F.lit("GET "), F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path)), F.lit(" HTTP/1.1"))
    request = F.concat_ws("\r\n", F.coalesce(get, F.lit("GET / HTTP/1.1")), _line("Host", host), F.lit(""), F.lit("")).cast("binary")
    http = F.concat_ws("\r\n", F.lit("HTTP/1.1 200 OK"), _line("Content-Type", "text/html; charset=utf-8"),
                       _line("Content-Length", F.col("bytes").cast("string")), F.lit(""), F.lit("")).cast("binary")
    metadata = F.concat_ws("\r\n", _line("page-id", F.col("id").cast("string")), F.lit("")).cast("binary")
    again = F.col("r_digest").isNotNull()
    about = [target, when, _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
             _line("Content-Type", "application/http;msgtype=response")]
    response = F.when(again, _record("revisit", F.col("r"), [*about, _line("WARC-Profile", PROFILE),
                                                             _line("WARC-Refers-To-Target-URI", F.col("r_url"))], http)
                      ).otherwise(_record("response", F.col("r"), about, F.concat(http, F.col("payload"))))
    beside = [target, when, _line("WARC-Concurrent-To", F.col("r"))]
    return j.select(F.explode(F.array(
        _record("request", F.col("q"), [*beside, _line("Content-Type", "application/http;msgtype=request")], request),
        response,
        _record("metadata", F.col("m"), [*beside, _line("Content-Type", "application/warc-fields")], metadata))).alias("record"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               date: str | None = None, min_revisit: int = 100, max_records_per_file: int | None = None) -> None:
    """Writes ``pages`` as gzip archives into the folder ``path`` (one per
    task, or of ``max_records_per_file`` records)."""
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    out = records_of(pages, id_col, url_col, payload_col, date, min_revisit)
    w = out.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END).option("compression", "gzip")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.text(path)


# -- reading --------------------------------------------------------------------

class _Stream:
    """Bytes of one archive in, (header lines, block) out."""

    def __init__(self) -> None:
        self.buffer, self.head, self.wanted = bytearray(), None, 0

    def feed(self, data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
        self.buffer += data
        while True:
            if self.head is None:
                while self.buffer[:2] == b"\r\n":
                    del self.buffer[:2]
                at = self.buffer.find(END.encode())
                if at < 0:
                    return
                lines = self.buffer[:at].decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"no WARC record: {lines[0][:60]!r}")
                self.head = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
                self.wanted = int(dict(self.head)["content-length"])
                del self.buffer[:at + 4]
            if len(self.buffer) < self.wanted:
                return
            block = bytes(self.buffer[:self.wanted])
            del self.buffer[:self.wanted]
            head, self.head = self.head, None
            yield head, block

    def close(self, path: str) -> None:
        if self.head is not None or self.buffer.strip(b"\r\n"):
            raise ValueError(f"truncated archive: {path}")


def _fields(block: bytes) -> list[tuple[str, str]]:
    seen: dict[str, str] = {}
    for line in block.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            seen.setdefault(name.strip().lower(), value.strip())
    return list(seen.items())


def _row(head: list[tuple[str, str]], block: bytes, payload: bool) -> tuple:
    get = dict(head).get
    kind, content = get("warc-type"), get("content-type") or ""
    status, http, fields, body = None, None, None, block
    if content.startswith("application/http"):
        top, _, body = block.partition(END.encode())
        first, _, rest = top.partition(b"\r\n")
        http = _fields(rest)
        words = first.split()
        status = int(words[1]) if kind != "request" and len(words) > 1 and words[1].isdigit() else None
    elif content.startswith("application/warc-fields"):
        fields = _fields(block)
    if kind == "revisit":                   # what it stands for, not what it holds
        length = dict(http or []).get("content-length", "")
        n, digest = int(length) if length.isdigit() else None, (get("warc-payload-digest") or "").partition(":")[2] or None
        body = None
    else:
        n, digest = len(body), hashlib.sha256(body).hexdigest()
    return (get("warc-record-id"), kind, get("warc-target-uri"), get("warc-date"), [v for k, v in head if k == "warc-concurrent-to"],
            get("warc-refers-to-target-uri"), get("warc-profile"), content, status, http, fields, n, digest, body if payload else None)


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives under ``path`` (see ``RECORD``); without
    ``payload`` that column is null and the payloads stay in the tasks that
    read them."""
    pieces = spark.read.option("lineSep", END).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("piece"))
    string = pa.string()
    kinds = [string, string, string, string, pa.list_(string), string, string, string, pa.int32(),
             pa.map_(string, string), pa.map_(string, string), pa.int64(), string, pa.binary()]
    names = [f.split()[0] for f in RECORD.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, here, rows, held = _Stream(), None, [], 0
        for b in batches:
            for name, start, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if name != here:
                    stream.close(here or "")
                    stream, here = _Stream(), name
                if start:
                    raise ValueError(f"an archive without gzip is larger than spark.sql.files.maxPartitionBytes: {name}")
                for head, block in stream.feed(piece.as_py() + END.encode()):
                    rows.append(_row(head, block, payload))
                    held += len(block) + 500
                    if held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
        stream.close(here or "")
        if rows:
            yield batch(rows)

    return pieces.mapInArrow(run, RECORD)


# -- assembling -------------------------------------------------------------------

def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` (a response or revisit),
    ``request`` and ``metadata`` (null where there is none)."""
    whole = F.struct(*records.columns)
    roots = records.filter(F.col("type").isin("response", "revisit"))
    beside = records.filter(F.col("type").isin("request", "metadata")).select("record_id", "concurrent_to", whole.alias("rec"))
    forward = beside.select(F.explode("concurrent_to").alias("root"), "rec")
    named = roots.select(F.col("record_id").alias("root"), F.explode("concurrent_to").alias("other"))
    backward = beside.join(named, F.col("record_id") == F.col("other")).select("root", "rec")

    def one(kind: str) -> Column:
        mine = F.col("rec.type") == kind
        return F.min_by("rec", F.when(mine, F.col("rec.record_id"))).alias(kind)

    sides = forward.unionByName(backward).groupBy("root").agg(one("request"), one("metadata"))
    return (roots.select(F.col("record_id").alias("capture_id"), whole.alias("response"))
            .join(sides, F.col("capture_id") == F.col("root"), "left").select("capture_id", "request", "response", "metadata"))
