"""WARC archives: a writer with one gzip member per record, and a splittable reader.

The reader's tasks take byte ranges. Each scans its range for the gzip magic, accepts a candidate only if it inflates to
the header of a WARC record, and owns the records that start inside its range, however far they reach beyond; from a
record on, the next starts where its member ends. Archives are reached through pyarrow.fs, so any store that it knows.

Payloads that occur more than once are written once: the copy with the largest page_id is the response and the others
revisit it. Payloads are told apart by SHA-1 and length; groups are pre-aggregated, and a payload shared by any number
of pages costs no more than its rows.

Defined cases: a null html is an empty payload; a null url gives a record without a URI; line ends in a url are
percent-encoded; rows that repeat with the same page_id are each a response if theirs is the largest; a null page_id is
smaller than any, and its record is read back as null; records that other writers named are read with a null page_id, and
of kinds other than response and revisit the whole block counts as payload; an empty table gives no archive and no rows;
other columns are not written.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import in_python, stored
from tidelog.settings import scratch_dir

SPLIT_BYTES = 8 << 20
ARCHIVE_BYTES = 256 << 20  # an archive is closed when it is this large
LEVEL = 4
_READ = 1 << 18

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = b"urn:page:"

RECORD_SCHEMA = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
)


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _fields(*pairs: tuple[bytes, bytes | None]) -> bytes:
    return b"".join(name + b": " + value + b"\r\n" for name, value in pairs if value is not None)


def record(page_id: int, url: str | None, payload: bytes, n_bytes: int, digest: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and drops the payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _fields(
        (b"Content-Type", b"text/html; charset=utf-8"), (b"Content-Length", b"%d" % n_bytes)
    )
    block = http + b"\r\n" + (payload if refers_to is None else b"")
    uri = None if url is None else url.encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A")
    header = VERSION + b"\r\n" + _fields(
        (b"WARC-Type", b"response" if refers_to is None else b"revisit"),
        (b"WARC-Record-ID", b"<" + RECORD + (b"%d>" % page_id if page_id is not None else b"none:%s>" % digest)),
        (b"WARC-Date", b"1970-01-01T00:00:00Z"),
        (b"WARC-Target-URI", uri),
        (b"WARC-Payload-Digest", b"sha1:" + digest),
        (b"WARC-Refers-To", None if refers_to is None else b"<" + RECORD + b"%d>" % refers_to),
        (b"WARC-Profile", None if refers_to is None else REVISIT_PROFILE),
        (b"Content-Type", b"application/http;msgtype=response"),
        (b"Content-Length", b"%d" % len(block)),
    )
    return header + b"\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, level: int):
    def write(batches):
        store, path = store_of(folder)
        out, name, size, done = None, None, 0, []
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*[batch.column(i) for i in range(5)]):
                if out is None:
                    # A new name for each attempt: what a lost task leaves behind is in no list.
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                payload = html.as_py()
                b32 = base64.b32encode(bytes.fromhex(digest.as_py()))
                member = gzip.compress(
                    record(page_id.as_py(), url.as_py(), payload, len(payload), b32, refers_to.as_py()), level, mtime=0
                )
                out.write(member)
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((name, size))
                    out, size = None, 0
        if out is not None:
            out.close()
            done.append((name, size))
        names, sizes = zip(*done) if done else ((), ())
        paths = pa.array([f"{folder}/{n}" for n in names], pa.string())
        yield pa.RecordBatch.from_arrays([paths, pa.array(sizes, pa.int64())], ["path", "bytes"])

    return write


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, level: int = LEVEL) -> DataFrame:
    """Write a record per page (page_id, url, html) below folder; returns the written list of archives: path, bytes."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select("page_id", F.col("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    seen = rows.select("page_id", "digest", F.length("payload").alias("n")).filter(F.col("n") >= min_revisit_bytes)
    shared = seen.groupBy("digest", "n").agg(F.max("page_id").alias("first"), F.count("*").alias("copies"))
    shared = shared.filter("copies > 1").select(F.col("digest").alias("_d"), F.col("n").alias("_n"), "first")
    # Stored, so that its size is known: Spark broadcasts a small list, and joins a large one with hot payloads split.
    shared = stored(shared, "warc-shared")
    told = rows.join(shared, (F.col("digest") == F.col("_d")) & (F.length("payload") == F.col("_n")), "left")
    refers_to = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    told = told.select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    return stored(in_python(told, _writer(folder, level), "path string, bytes bigint"), "warc-list")


def inflated(data: bytes, at: int, more) -> tuple[bytes, int] | None:
    """The record whose member starts at `at`, and where it ends; None if no WARC record starts there.

    more() gives the bytes that follow data, and b"" at the end of the archive.
    """
    member = zlib.decompressobj(31)
    parts, got, source, used = [], 0, data[at : at + _READ], 0
    while True:
        try:
            piece = member.decompress(source)
        except zlib.error:
            return None
        used += len(source) - len(member.unused_data)
        if piece:
            parts.append(piece)
            got += len(piece)
            if got - len(piece) < len(VERSION) and not b"".join(parts).startswith(VERSION[: min(got, 7)]):
                return None
        if member.eof:
            whole = b"".join(parts)
            return (whole, at + used) if whole.startswith(VERSION[:7]) else None
        source = data[at + used : at + used + _READ] or more(at + used)
        if not source:
            return None


def _named(head: bytes) -> dict[bytes, bytes]:
    """Header fields after the first line."""
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {name: value.strip() for name, _, value in pairs}


def parsed(whole: bytes, with_payload: bool) -> tuple:
    """The record's columns as in RECORD_SCHEMA; digest and length of a response are taken from its payload."""
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = _named(head)
    block = rest[: int(fields[b"Content-Length"])]
    kind = fields.get(b"WARC-Type", b"").decode()
    http, _, payload = block.partition(b"\r\n\r\n") if kind in ("response", "revisit") else (b"", b"", block)

    def page(name: bytes) -> int | None:
        own = fields.get(name, b"").strip(b"<>")
        number = own.removeprefix(RECORD)
        return int(number) if own.startswith(RECORD) and number.removeprefix(b"-").isdigit() else None

    if kind == "revisit":
        length = _named(http).get(b"Content-Length", b"")
        digest = fields.get(b"WARC-Payload-Digest", b"").removeprefix(b"sha1:").decode() or None
        n = int(length) if length.isdigit() else None
    else:
        n, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    url = fields[b"WARC-Target-URI"].decode() if b"WARC-Target-URI" in fields else None
    row = (page(b"WARC-Record-ID"), n, digest, kind, page(b"WARC-Refers-To"), url)
    return (*row, payload if kind == "response" else None) if with_payload else row


def records_in(file, start: int, end: int):
    """The records that start in [start, end) of a seekable archive, in order."""
    file.seek(start)
    data = file.read(end - start + len(MAGIC) - 1)
    tail = [start + len(data)]

    def more(at):
        file.seek(max(start + at, tail[0]))
        return file.read(_READ)

    at = data.find(MAGIC)
    while 0 <= at < end - start:
        found = inflated(data, at, more)
        if found is None:
            at = data.find(MAGIC, at + 1)
        else:
            yield found[0]
            at = data.find(MAGIC, found[1])


def _reader(with_payload: bool, schema: pa.Schema):
    def read(batches):
        for batch in batches:
            for path, start, end in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                store, name = store_of(path)
                rows, size = [], 0
                with store.open_input_file(name) as file:
                    for whole in records_in(file, start, end):
                        rows.append(parsed(whole, with_payload))
                        size += len(whole) if with_payload else 200
                        if size > SPLIT_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return read


def read_archives(archives: DataFrame, with_payload: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of archives (path, bytes), as RECORD_SCHEMA and, if asked for, the payload of responses."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))
    splits = archives.filter("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
    splits = splits.select("path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"))
    n = archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    schema = pa.schema(list(zip(names, types))[: 7 if with_payload else 6])
    columns = RECORD_SCHEMA + (", payload binary" if with_payload else "")
    return in_python(splits.repartition(int(n)), _reader(with_payload, schema), columns)


def archive_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages and read the archives back: one row per record."""
    folder = scratch_dir(spark, "warc")
    return read_archives(write_archives(pages, folder)).drop("url")
