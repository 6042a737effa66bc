"""WARC archives: one gzip member per record, written and read sequentially."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm.common import file_system, new_folder, tasks, text_of
from turnmill.session import save_step

DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 1 << 30
READ_BYTES = 1 << 20
ROWS_OUT = 500
LEVEL = 3

FILE_DDL = "file STRING, records BIGINT, bytes BIGINT"
FILE = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORD = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)
RECORD_DDL = (
    "record_id STRING, record_type STRING, uri STRING, refers_to STRING, "
    "payload_digest STRING, payload_bytes BIGINT, payload BINARY"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def one_line(value: str) -> str:
    """A header value: no line breaks, no blanks at its ends."""
    return re.sub(r"[\r\n]+", " ", value).strip()


def record(page: str, uri: str, payload: bytes, refers_to: str | None) -> bytes:
    """One record, uncompressed. A revisit holds the response's headers but no payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {one_line(uri)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of each gzip member of a stream, one at a time."""
    inflate, parts = None, []
    for chunk in chunks:
        while chunk:
            inflate = inflate or zlib.decompressobj(31)
            parts.append(inflate.decompress(chunk))
            chunk = inflate.unused_data
            if inflate.eof:
                yield b"".join(parts)
                inflate, parts = None, []
    if inflate is not None:
        raise ValueError("the archive ends inside a record")


def parse(data: bytes) -> dict:
    """A record's headers and payload; digests and lengths must agree."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']}: the content length is wrong")
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"{fields['WARC-Record-ID']}: the block digest is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    if fields["WARC-Type"] == "response" and (
        len(payload) != length or fields["WARC-Payload-Digest"] != f"sha1:{digest(payload)}"
    ):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload digest is wrong")
    return {
        "record_id": fields["WARC-Record-ID"],
        "record_type": fields["WARC-Type"],
        "uri": fields["WARC-Target-URI"],
        "refers_to": fields.get("WARC-Refers-To"),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": length,
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def write_warc(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Write every row as a record; returns the files: file, records, bytes.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest key is a response and the others revisit it; a row without a key
    revisits too unless no row of its group has a key. Null payloads are empty,
    null addresses too. Rows that share key and payload are alike.
    """
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        text_of(html).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    firsts = (
        rows.select("page_id", "sha", F.octet_length("payload").alias("n"))
        .filter(F.col("n") >= min_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1 AND first IS NOT NULL")
        .select(F.col("sha").alias("s"), "first")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    marked = rows.join(firsts, F.col("sha") == F.col("s"), "left").select("page_id", "url", "payload", refers.alias("refers"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        out, name, records, size = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [name], "records": [records], "bytes": [size]}, schema=FILE)

        for batch in batches:
            for page, uri, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    # A new name for every attempt: files of lost attempts are named by no row.
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, records, size = system.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = record("" if page is None else str(page), uri, payload, None if refers_to is None else str(refers_to))
                size += out.write(packer.compress(data) + packer.flush())
                records += 1
                if size >= FILE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return save_step(marked.mapInArrow(write, FILE_DDL), "warc_files")


def read_warc(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """The records of the files, checked. A file is read from start to end, record by record."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{name}", compression=None) as f:
                    rows, held = [], 0
                    for data in members(iter(lambda: f.read(READ_BYTES), b"")):
                        rows.append(parse(data))
                        held += len(data)
                        if len(rows) >= ROWS_OUT or held >= 16 * READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=RECORD)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD)

    return files.select("file").repartition(tasks(spark), "file").mapInArrow(read, RECORD_DDL)


def page_id(column: str) -> Column:
    """The key in a record's name; null where the row had none."""
    key = F.regexp_extract(column, r"^<urn:page:(.*)>$", 1)
    return F.when(key != "", key).cast("bigint")


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back, with page_id and refers_to."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    records = read_warc(spark, write_warc(pages, folder, min_bytes=min_bytes), folder)
    return records.withColumn("page_id", page_id("record_id")).withColumn("refers_to", page_id("refers_to"))
