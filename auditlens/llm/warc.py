"""Legacy ARC archives converted to WARC, with revisit records for equal payloads (operator 10).

Method: an ARC file begins with a ``filedesc`` record that names its version;
each record is a header line whose fields depend on the version (1: URL, IP,
date, type, length; 2: also result code, checksum, location, offset, file
name) and as many bytes as the line declares. The converter reads every
record by its declared length and synthesises what WARC asks for: record
identifiers (UUIDs derived from file and place), ISO timestamps, record
types (``warcinfo`` for the file description, ``response`` for HTTP,
``resource`` for the rest) and SHA-1 digests of block and payload.

Records of one payload digest (from ``min_revisit`` bytes on) become one response, that
with the largest page id, and revisits of it. Files are written and read by
tasks in shared storage; only digests, lengths and places are shuffled, and
they are aggregated before. Files of tasks that ran twice are not named in
the manifest and so do not count.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm.shared import filesystem, run_folder, written

MIN_REVISIT = 1000
CAPTURED = "20240101000000"
FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
TITLES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PER_FILE = 20_000  # records


class Arc(NamedTuple):
    """A record of an ARC file: the fields of its header line, its bytes, whether bytes are missing."""

    fields: dict[str, str]
    body: bytes
    truncated: bool


def member(data: bytes) -> bytes:
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def arc_file_header(name: str, version: int, date: str = CAPTURED) -> bytes:
    body = f"{version} 0 auditlens\n{TITLES[version]}\n\n".encode()
    line = {1: f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}",
            2: f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}"}[version]
    return line.encode() + b"\n" + body


def arc_record(version: int, url: str, body: bytes, name: str, offset: int, kind: str = "text/html", date: str = CAPTURED) -> bytes:
    url = re.sub(r"[\s\x00-\x1f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) or "unknown:"
    line = {1: f"{url} 0.0.0.0 {date} {kind} {len(body)}",
            2: f"{url} 0.0.0.0 {date} {kind} 200 - - {offset} {name} {len(body)}"}[version]
    return line.encode() + b"\n" + body + b"\n"


#: Header lines. The URL may hold blanks and the type parameters, so the fixed fields between them are looked for.
_PLACE = r"(?P<url>.*) (?P<ip>[0-9A-Fa-f.:]+|-) (?P<date>\d{4,17}) (?P<type>.*)"
LINES = {
    1: re.compile(_PLACE + r" (?P<length>\d+)"),
    2: re.compile(_PLACE + r" (?P<result>\d+|-) (?P<checksum>\S+) (?P<location>\S+) (?P<offset>\d+|-) (?P<filename>\S+) (?P<length>\d+)"),
}


def read_arc(stream: BinaryIO, refused: list[str] | None = None) -> Iterator[Arc]:
    """Records of an ARC file, the file description first; raises ValueError if that is missing or of no known version.

    A line that is no header line goes to ``refused``; if it ends with a length, so many bytes are skipped, else the
    next header line is looked for.
    """
    version = None
    while line := stream.readline():
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if version is None:
            if not text.startswith("filedesc:"):
                raise ValueError("an ARC file begins with a filedesc record")
            found = LINES[2].fullmatch(text) or LINES[1].fullmatch(text)
            if not found:
                raise ValueError(f"no ARC header line: {text[:200]!r}")
        else:
            found = LINES[version].fullmatch(text)
        if not found:
            if refused is not None:
                refused.append(text[:200])
            length = text.rpartition(" ")[2]
            if length.isdigit():
                stream.read(int(length))
            continue
        fields = {name: found[name] for name in found.groupdict()}
        body = stream.read(int(fields["length"]))
        if version is None:
            head = body.split(b" ", 1)[0]
            version = int(head) if head.isdigit() else None
            if version not in FIELDS:
                raise ValueError(f"unknown ARC version {head[:20]!r}")
        yield Arc(fields, body, len(body) < int(fields["length"]))


def iso_date(date: str) -> str:
    """A WARC date from the digits of an ARC one; what is missing or impossible is the least possible (month and day 01)."""
    for n in (14, 12, 10, 8, 6, 4):
        if len(date) >= n:
            whole = date[:n] + "YYYY0101000000"[n:]
            try:
                return dt.datetime.strptime(whole, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")
            except ValueError:
                continue
    return "0001-01-01T00:00:00Z"


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their blank line, and payload."""
    ends = [m.end() for m in (re.search(rb"\r\n\r\n", body), re.search(rb"\n\n", body)) if m]
    at = min(ends) if body.startswith(b"HTTP/") and ends else 0
    return body[:at], body[at:]


def http_field(headers: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", headers)
    return found[1].decode() if found else None


def sha1_32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(arc: Arc, name: str, number: int, revisit_of: dict | None = None) -> bytes:
    """The WARC record of an ARC record; ``revisit_of`` has id, page and url of the response it repeats."""
    iso = iso_date(arc.fields["date"])
    headers, payload = split_http(arc.body)
    block = arc.body
    page = http_field(headers, "X-Page-Id")
    lines = ["WARC/1.1", f"WARC-Record-ID: <{record_id(name, number)}>", f"WARC-Date: {iso}"]
    if arc.fields["url"].startswith("filedesc:"):
        kind, media = "warcinfo", "text/plain"
        lines.append(f"WARC-Filename: {arc.fields['url'].removeprefix('filedesc://')}")
    else:
        kind, media = ("response", "application/http; msgtype=response") if headers else ("resource", arc.fields["type"])
        lines.append(f"WARC-Target-URI: {arc.fields['url']}")
        lines.append(f"WARC-IP-Address: {arc.fields['ip']}")
        lines.append(f"WARC-Payload-Digest: {sha1_32(payload)}")
    if revisit_of:
        kind, block = "revisit", headers
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{revisit_of['id']}>"]
        if revisit_of["page"] is not None:
            lines.append(f"X-Refers-To-Page-Id: {revisit_of['page']}")
    if arc.truncated:
        lines.append("WARC-Truncated: unspecified")
    if page is not None:
        lines.append(f"X-Page-Id: {page}")
    lines[1:1] = [f"WARC-Type: {kind}"]
    lines += [f"WARC-Block-Digest: {sha1_32(block)}", f"Content-Type: {media}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(name: str, number: int) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{number}").urn


def read_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:100]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode().partition(":")
            fields[key.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


def write_arc(pages: DataFrame, folder: str) -> DataFrame:
    """ARC files of all pages (versions 1 and 2 in turn); the manifest: file, records."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        version = 1 + task % 2
        out, name, n, files = None, "", 0, 0
        for batch in batches:
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"pages-{task:06d}-{files:04d}-{attempt}.arc.gz"
                    store.create_dir(f"{root}/arc", recursive=True)
                    out = store.open_output_stream(f"{root}/arc/{name}", compression=None)
                    out.write(member(arc_file_header(name, version)))
                payload = (html or "").encode()
                headers = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                headers += f"X-Page-Id: {page}\r\n" * (page is not None) + f"Content-Length: {len(payload)}\r\n\r\n"
                out.write(member(arc_record(version, url or "", headers.encode() + payload, name, out.tell())))
                n += 1
                if n == _PER_FILE:
                    out.close()
                    yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})
                    out, n, files = None, 0, files + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})

    return written(rows.mapInArrow(run, "file string, records long"), f"{folder}/arc-files")


def spread(manifest: DataFrame) -> DataFrame:
    """One file to a task, as far as it goes."""
    return manifest.repartition(max(1, min(manifest.count(), 10_000)), "file")


def index_arc(manifest: DataFrame, folder: str) -> DataFrame:
    """file, number, page_id, url, bytes and sha1 of the payload, of every page record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out: tuple[list, ...] = ([], [], [], [], [])
                with store.open_input_stream(f"{root}/arc/{name}", compression=None) as f, gzip.GzipFile(fileobj=f) as records:
                    for number, arc in enumerate(read_arc(records)):
                        if number:
                            headers, payload = split_http(arc.body)
                            page = http_field(headers, "X-Page-Id")
                            for column, value in zip(out, (number, None if page is None else int(page), arc.fields["url"],
                                                           len(payload), hashlib.sha1(payload).digest()), strict=True):
                                column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(out[0])), *(pa.array(v, t) for v, t in zip(out, kinds, strict=True))],
                    names=["file", "number", "page_id", "url", "bytes", "sha1"])

    return written(spread(manifest.select("file")).mapInArrow(
        run, "file string, number long, page_id long, url string, bytes long, sha1 binary"), f"{folder}/index")


def revisits(index: DataFrame, min_bytes: int, rows_per_salt: int = 50_000) -> DataFrame:
    """file and its revisit records: number, and the file, number and page of the response.

    The response is the record with the largest page id (null: smallest;
    then by file and number). Salted on both sides, so that a payload that
    many pages share is split: into as many parts as its number asks for.
    """
    large = index.where(F.col("bytes") >= min_bytes)
    best = large.groupBy("sha1", "bytes").agg(
        F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("o"), "file", "number", "page_id")).alias("r"),
        F.count("*").alias("n")).where("n > 1")
    salts = -(-int(best.agg(F.max("n")).first()[0] or 1) // rows_per_salt)
    salts = max(16, salts)
    best = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    mine = large.withColumn("salt", F.pmod(F.xxhash64("file", "number"), F.lit(salts)).cast("int"))
    both = mine.join(best, ["sha1", "bytes", "salt"]).where("file <> r.file or number <> r.number")
    return both.groupBy("file").agg(F.collect_list(F.struct(
        "number", F.col("r.file").alias("of_file"), F.col("r.number").alias("of_number"), F.col("r.page_id").alias("page_id"))
    ).alias("revisits"))  # at most as many as the file has records


def convert(manifest: DataFrame, repeated: DataFrame, folder: str) -> DataFrame:
    """A WARC file for each ARC file; the manifest: file, records, refused (lines that are no header line)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(f"{root}/warc", recursive=True)
        for batch in batches:
            for name, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                again = {r["number"]: {"id": record_id(r["of_file"], r["of_number"]), "page": r["page_id"]} for r in own or ()}
                target = f"{name.removesuffix('.arc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
                n, refused = 0, []
                with (store.open_input_stream(f"{root}/arc/{name}", compression=None) as f, gzip.GzipFile(fileobj=f) as records,
                      store.open_output_stream(f"{root}/warc/{target}", compression=None) as out):
                    for number, arc in enumerate(read_arc(records, refused)):
                        out.write(member(warc_record(arc, name, number, again.get(number))))
                        n += 1
                yield pa.RecordBatch.from_pydict({"file": [target], "records": [n], "refused": [len(refused)]})

    rows = manifest.select("file").join(repeated, "file", "left")
    return written(spread(rows).mapInArrow(run, "file string, records long"), f"{folder}/warc-files")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest (SHA-1, hex), record_type and refers_to of every record but warcinfo.

    Bytes and digest are of the full payload: of a response as read (and held
    against the digest in its header), of a revisit as its headers declare.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out: tuple[list, ...] = ([], [], [], [], [])
                with store.open_input_stream(f"{root}/warc/{name}", compression=None) as f, gzip.GzipFile(fileobj=f) as records:
                    for fields, block in read_warc(records):
                        kind = fields["warc-type"]
                        if kind == "warcinfo":
                            continue
                        headers, payload = split_http(block)
                        declared = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
                        size = len(payload)
                        if kind == "revisit":
                            size = int(http_field(headers, "Content-Length") or 0)
                        elif hashlib.sha1(payload).digest() != declared:
                            raise ValueError(f"{name}: {fields['warc-record-id']} does not have the payload that its digest names")
                        page, of = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                        for column, value in zip(out, (None if page is None else int(page), size, declared.hex(), kind,
                                                       None if of is None else int(of)), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)],
                                                 names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = spark.read.schema("file string, records long").parquet(f"{folder}/warc-files")
    return spread(files.select("file")).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, folder: str | None = None, min_revisit: int = MIN_REVISIT) -> str:
    """Writes ``pages`` as ARC files, converts them to WARC files; returns the folder (``arc/``, ``warc/``, manifests).

    A null or empty html is an empty payload, a null url the target
    ``unknown:``, a null page_id a record without one; repeated rows are
    records of their own, and other columns are left out. An empty table
    gives no files.
    """
    folder = folder or run_folder(pages.sparkSession, "warc")
    files = write_arc(pages, folder)
    index = index_arc(files, folder)
    convert(files, revisits(index, min_revisit), folder)
    return folder


#: Records of equal payloads in SQL, over ``pages``.
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
FROM g
"""
