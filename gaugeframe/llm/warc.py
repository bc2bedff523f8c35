"""WARC archives: a writer, and a reader whose tasks split files at gzip members.

Every record is one gzip member. A reading task takes a byte range of a file, looks for the
gzip magic, accepts a candidate only if what it inflates to begins like a WARC record, and owns
the records that start inside its range, reading past its end where the last one does.

Files are reached through ``pyarrow.fs``, which knows local and shared folders (``file``) and
``s3``, ``gs``, ``abfss`` and ``hdfs`` as far as the installed build supports them.

Null payloads read as empty. Rows that repeat the smallest page id of a payload are responses
as well; a null page id counts as larger than any other. An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.skew import attach_by_key
from .shared import shared_path, written

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 8 << 20
FILE_BYTES = 256 << 20
MAX_TASKS = 50_000
HEAD = b"WARC/1."
DATE = "1970-01-01T00:00:00Z"
RECORD = ("path string, offset bigint, record_type string, record_id string, refers_to string, "
          "target_uri string, payload_digest string, payload_bytes bigint")


def open_folder(uri: str):
    """The filesystem of a URI or path, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file:///" + uri[5:].lstrip("/")
    elif "://" not in uri:
        uri = "file://" + uri
    return fs.FileSystem.from_uri(uri)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- writing

def mark_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """``pages`` as (id, uri-less rest, payload, first): ``first`` is the smallest id among equal
    payloads of ``min_bytes`` or more, else the row's own id."""
    rows = pages.withColumn("payload", F.encode(F.coalesce(F.col(payload_col).cast("string"),
                                                           F.lit("")), "utf-8"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    firsts = rows.select("digest", F.col(id_col).alias("id")).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    # One payload may fill a third of the table: heavy digests meet a bounded broadcast.
    rows = attach_by_key(rows, firsts, ["digest"], "copies")
    return rows.withColumn("first", F.when(F.octet_length("payload") >= min_bytes, F.col("first"))
                           .otherwise(F.col(id_col)))


def _member(kind: str, page: str, uri: str | None, first: str, payload: bytes) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
            f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response"]
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{first}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        block = http
    else:
        block = http + payload
    head.append(f"Content-Length: {len(block)}")
    out = zlib.compressobj(6, zlib.DEFLATED, 31)
    record = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return out.compress(record) + out.flush()


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url",
               payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write a record per row under ``folder``; returns the archive's files (path, bytes,
    records), a written table. Files get fresh names, so a repeated or doubled task can't damage
    another's; only the files that the table lists belong to the archive."""
    marked = mark_revisits(pages, id_col, payload_col, min_bytes)
    rows = marked.select(
        F.col(id_col).cast("string").alias("page"), F.col(uri_col).cast("string").alias("uri"),
        F.col("first").cast("string").alias("first"), "payload",
        F.when(F.col("first").eqNullSafe(F.col(id_col)), "response").otherwise("revisit").alias("kind"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, at = open_folder(folder)
        out, path, size, records, done = None, "", 0, 0, []
        for batch in batches:
            for i in range(batch.num_rows):
                page, uri, first, payload, kind = (batch.column(c)[i].as_py() for c in
                                                   ("page", "uri", "first", "payload", "kind"))
                if out is None:
                    root.create_dir(at, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, size, records = f"{folder.rstrip('/')}/{name}", 0, 0
                    out = root.open_output_stream(f"{at}/{name}", compression=None)
                member = _member(kind, page or "", uri, first or "", payload)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((path, size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, records))
        paths, sizes, counts = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            names=["path", "bytes", "records"])

    return written(rows.mapInArrow(save, "path string, bytes bigint, records bigint"), "warc-files")


# ---- reading

def _inflate_head(data: bytes) -> bytes:
    try:
        return zlib.decompressobj(31).decompress(data, len(HEAD))
    except zlib.error:
        return b""


def _header(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return fields, body


def members(source, start: int, end: int, step: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the gzip members that begin in [start, end) and hold WARC records.

    ``source`` has ``seek`` and ``read``. Bytes are held only from the member being looked at.
    """
    held, base, more = b"", start, True  # held = file bytes from ``base``

    def fill(upto: int) -> bool:
        nonlocal held, more
        while more and base + len(held) < upto:
            source.seek(base + len(held))
            piece = source.read(step)
            more = bool(piece)
            held += piece
        return base + len(held) >= upto

    at = start
    while at < end:
        fill(min(at + step, end) + len(MAGIC) - 1)
        hit = held.find(MAGIC, at - base)
        if hit < 0 or base + hit >= end:
            at = base + len(held) - len(MAGIC) + 1
            held, base = held[max(0, at - base):], max(base, at)
            if not more:
                return
            continue
        held, base = held[hit:], base + hit
        at = base
        fill(at + 512)
        if _inflate_head(held[:512]) != HEAD:
            at += 1
            continue
        inflate, parts, used = zlib.decompressobj(31), [], 0
        try:
            while not inflate.eof:
                if used == len(held) and not fill(base + used + 1):
                    raise zlib.error("the file ends inside a member")
                piece = held[used:used + step]
                used += len(piece)
                parts.append(inflate.decompress(piece))
        except zlib.error:
            at += 1  # looked like a record, but is not a whole member
            continue
        used -= len(inflate.unused_data)
        yield at, b"".join(parts)
        held, base = held[used:], base + used
        at = base


def _fields(path: str, offset: int, record: bytes) -> dict:
    fields, block = _header(record)
    block = block[:int(fields.get("content-length", len(block)))]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    kind = fields.get("warc-type")
    size = int(fields["x-payload-length"]) if "x-payload-length" in fields else None
    if kind != "revisit":
        payload = block
        if fields.get("content-type", "").startswith("application/http"):
            payload = block.partition(b"\r\n\r\n")[2]
        real = sha1_base32(payload)
        if digest not in (None, real):
            raise ValueError(f"{path} at {offset}: payload does not match its digest")
        digest, size = real, len(payload)

    def bare(name: str) -> str | None:
        return fields[name].strip("<>") if name in fields else None

    return {"path": path, "offset": offset, "record_type": kind,
            "record_id": bare("warc-record-id"), "refers_to": bare("warc-refers-to"),
            "target_uri": fields.get("warc-target-uri"), "payload_digest": digest,
            "payload_bytes": size}


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the files under a folder, for archives without a table of files."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select("path", F.col("length").alias("bytes"))


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of archive files (path, bytes); a task per byte range, however large a file."""
    ranges = files.filter("bytes > 0").select("path", "bytes", F.explode(F.expr(
        f"sequence(0L, bytes - 1, {int(split_bytes)}L)")).alias("start"))
    ranges = ranges.select("path", "start", F.least(
        F.col("bytes"), F.col("start") + F.lit(int(split_bytes))).alias("end"))
    schema = pa.schema([(n, pa.int64() if t == "bigint" else pa.string())
                        for n, t in (f.split() for f in RECORD.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                root, at = open_folder(row["path"])
                rows = []
                with root.open_input_file(at) as source:
                    for offset, record in members(source, row["start"], row["end"]):
                        rows.append(_fields(row["path"], offset, record))
                        if len(rows) == 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    # The list of ranges is small, so the number of tasks is given, not derived from its size.
    ranges = written(ranges, "warc-ranges")
    tasks = max(1, min(ranges.count(), MAX_TASKS))
    return ranges.repartition(tasks, "path", "start").mapInArrow(read, RECORD)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    records = read_warc(write_warc(pages, shared_path(spark, "warc")))

    def page(column: str):
        return F.when(F.col(column) != "urn:page:",
                      F.substring_index(column, ":", -1).cast("bigint"))

    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", page("refers_to").alias("refers_to"))
