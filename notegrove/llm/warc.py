"""Web archives: one gzip member per record, written and read in sequence.

Writing: of equal payloads one record is the response, the others revisit it (only digests
and ids are shuffled for that). Each task writes its records to archives of bounded size in
the shared folder; the list of archives is itself a stored table, so an archive left by a
lost attempt is never read. Reading: each task inflates its archives a block at a time,
frames records by content-length and checks both digests, one record in memory at a time.

Defined results: a null payload is empty; a null url leaves out the target; a null id is
written as an empty one and read back as null; rows that repeat are one record each (of equal
payloads all rows with the largest id are responses); an empty table gives no archive and an
empty result. Other columns of the input are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.workspace import materialize, new_folder

# Payloads from this size on are written once.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the path in it."""
    return fs.FileSystem.from_uri(path if re.match(r"\w+://|file:", path) else f"file://{path}")


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    digits = name[len("<urn:page:") : -1] if name else ""
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, a gzip member of its own."""
    head = [("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url:
        head.append(("WARC-Target-URI", quote(url, safe=";/?:@&=+$,#%[]!*'()~")))
    head.append(("WARC-Payload-Digest", digest))
    if refers_to is None:
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        kind, block = "response", http + payload
    else:
        kind, block = "revisit", b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head += [("WARC-Type", kind), ("WARC-Block-Digest", sha1(block)), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in head)]
    deflate = zlib.compressobj(4, zlib.DEFLATED, 31)
    return deflate.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


class Damaged(ValueError):
    """An archive that breaks the format or holds other bytes than its digests say."""


def members(stream: BinaryIO, size: int = READ_BYTES) -> Iterator[bytes]:
    """The content of one gzip member after the other, inflated as the bytes come in."""
    data = b""
    while True:
        data = data or stream.read(size)
        if not data:
            return
        inflate, out = zlib.decompressobj(31), []
        while True:
            try:
                out.append(inflate.decompress(data))
            except zlib.error as e:
                raise Damaged(f"not a gzip member: {e}") from e
            if inflate.eof:
                break
            data = stream.read(size)
            if not data:
                raise Damaged("the archive ends within a member")
        data = inflate.unused_data
        yield b"".join(out)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and the block that content-length frames, checked."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/"):
        raise Damaged("no record header")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        headers[name.strip().lower().decode()] = value.strip().decode()
    try:
        length = int(headers["content-length"])
    except (KeyError, ValueError) as e:
        raise Damaged("no content-length") from e
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise Damaged(f"content-length {length} does not frame the record")
    block = rest[:length]
    if headers.get("warc-block-digest", sha1(block)) != sha1(block):
        raise Damaged("block digest differs")
    return headers, block


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The payload of a response, checked against its digest."""
    _, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or headers.get("warc-payload-digest", sha1(payload)) != sha1(payload):
        raise Damaged("payload digest differs")
    return payload


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write every row as a record. The result, stored, lists the archives and their records."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    # Digests that come twice, with the largest id; one narrow row per digest and task.
    big = rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
    twice = big.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "last")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("last")), None).otherwise(F.col("last"))
    rows = rows.join(twice, "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = store(folder)
        files.create_dir(base, recursive=True)
        out, name, n, size, made = None, "", 0, 0, []
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, refers_to = (batch.column(c)[i].as_py() for c in range(4))
                if out is None:
                    name, n, size = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                data = record(page_id, url, payload, sha1(payload), refers_to)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    made.append((f"{folder}/{name}", n, size))
        if out is not None:
            out.close()
            made.append((f"{folder}/{name}", n, size))
        cols = list(zip(*made, strict=True)) if made else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["archive", "n_records", "bytes"])

    return materialize(rows.mapInArrow(run, "archive string, n_records long, bytes long"), "warc-list")


RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
BATCH_ROWS = 2000


def records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one at a time."""
    files, name = store(path)
    with files.open_input_stream(name, compression=None) as stream:
        yield from map(parse, members(stream))


def read(archives: DataFrame) -> DataFrame:
    """One row per record of the listed archives. A revisit takes size and digest of the
    payload from the response that it names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(RECORDS)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, RECORDS, strict=True)], schema=RECORDS)

        for batch in batches:
            for path, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen = 0
                for headers, block in records(path):
                    seen += 1
                    kind = headers["warc-type"]
                    size = len(payload_of(headers, block)) if kind == "response" else None
                    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                    rows.append((page_of(headers["warc-record-id"]), size, digest, kind, page_of(headers.get("warc-refers-to")), headers.get("warc-target-uri")))
                    if len(rows) >= BATCH_ROWS:
                        yield packed()
                        rows = []
                if n is not None and seen != n:
                    raise Damaged(f"{path} holds {seen} records, not {n}")
        yield packed()

    found = archives.select("archive", "n_records").repartition(spread(archives), "archive").mapInArrow(run, ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in RECORDS))
    return materialize(found, "warc-records")


def spread(archives: DataFrame) -> int:
    """One task per archive, at most as many as shuffles have."""
    return max(1, min(archives.count(), int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def resolved(found: DataFrame) -> DataFrame:
    """Records read back, revisits with the payload size of the response that they name;
    the digests have to agree."""
    named = found.filter("refers_to IS NOT NULL").select("refers_to", "payload_digest").distinct()
    sizes = (
        found.filter("record_type = 'response'")
        .select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes")
        .join(named, ["refers_to", "payload_digest"], "left_semi")
        .groupBy("refers_to", "payload_digest")
        .agg(F.max("payload_bytes").alias("_bytes"))
    )
    return found.join(sizes, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "url"
    )


def roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write all rows, read all archives back: one row per record."""
    return resolved(read(write(pages, id_col, url_col, payload_col)))


def archives_in(spark: SparkSession, pattern: str) -> DataFrame:
    """The list of archives that match a path pattern, for files of other writers; the
    count of records is then unknown and is taken as read."""
    return spark.read.format("binaryFile").load(pattern).select(F.col("path").alias("archive"), F.lit(None).cast("long").alias("n_records"))
