"""WARC archives: one gzip member per record, and a sequential reader.

The writer turns each partition into one archive; the reader walks an archive
from start to end, inflating a block at a time, framing records by their
``Content-Length`` and checking every digest.  Neither holds more than one
record.  Archives lie in a folder that all executors share; paths are opened
through ``pyarrow.fs`` (``file:``, ``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscope.llm.common import stage_path

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

BLOCK_BYTES = 1 << 20
RECORD_SCHEMA = ("archive string, page_id long, url string, record_type string, refers_to long, "
                 "payload_bytes long, payload_digest string, payload binary")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _open(path: str):
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def record_bytes(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One uncompressed record.  A revisit carries the HTTP head alone; its
    payload's digest and length stay in the headers.  Ids of pages travel in
    ``X-Page-ID`` and ``X-Refers-To-Page-ID`` (absent: null)."""
    digest = base32_sha1(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    clean = " ".join((url or "").split())
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{revisit}')}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", clean or "about:blank"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if page_id is not None:
        lines.append(("X-Page-ID", str(page_id)))
    if revisit:
        lines.append(("WARC-Profile", REVISIT_PROFILE))
        lines.append(("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}/{digest}/False')}>"))
        if refers_to is not None:
            lines.append(("X-Refers-To-Page-ID", str(refers_to)))
    lines.append(("Content-Length", str(len(block))))
    text = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
    return text + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def members(stream, block: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The gzip members of a stream, inflated one by one.  Raises ``EOFError``
    where the last one is cut off."""
    inflater, parts, pending = zlib.decompressobj(31), [], b""
    while True:
        data = pending or stream.read(block)
        pending = b""
        if not data:
            if parts or inflater.unconsumed_tail:
                raise EOFError("archive ends inside a gzip member")
            return
        parts.append(inflater.decompress(data))
        if inflater.eof:
            yield b"".join(parts)
            pending = inflater.unused_data
            inflater, parts = zlib.decompressobj(31), []


def parse_record(data: bytes) -> dict:
    """Headers and block of a record; checks framing and both digests."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.decode("utf-8").partition(":")
        headers[name.strip().lower()] = value.strip()
    size = int(headers["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("record is not framed by its Content-Length")
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = headers.get("warc-type")
    if kind == "response" and digest and digest != base32_sha1(payload):
        raise ValueError("payload digest differs")
    length = len(payload)
    for line in http.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if kind == "revisit" and name.strip().lower() == b"content-length":
            length = int(value)
    number = lambda k: int(headers[k]) if k in headers else None
    return {"page_id": number("x-page-id"), "url": headers.get("warc-target-uri"), "record_type": kind,
            "refers_to": number("x-refers-to-page-id"), "payload_bytes": length, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def deduplicate(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with ``revisit`` and ``refers_to``.  Of
    pages with equal payloads of ``min_bytes`` or more, the one with the
    smallest page_id (null last) is the response; among rows that tie, the
    first of the input's own order."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns({
        "digest": F.unhex(F.sha1("payload")),
        "seat": F.monotonically_increasing_id()})
    place = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page_id"), F.col("seat").alias("seat"))
    first = rows.filter(F.length("payload") >= min_bytes).groupBy(F.col("digest").alias("d")).agg(F.min(place).alias("first"))
    joined = rows.join(first, F.col("digest") == F.col("d"), "left")
    revisit = F.coalesce((F.length("payload") >= min_bytes) & (F.col("seat") != F.col("first.seat")), F.lit(False))
    return joined.select("page_id", "url", "payload", revisit.alias("revisit"),
                         F.when(revisit, F.col("first.page_id")).alias("refers_to"))


def write_warc(records: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Write one archive for each partition of ``records`` (see
    :func:`deduplicate`) below ``folder``; returns (archive, n_records).

    An archive is written under a name of its attempt and renamed when whole:
    a task that is run again replaces it by the same records."""

    def save(batches):
        part, out, path = TaskContext.get(), None, None
        n = 0
        filesystem, base = _open(folder)
        for batch in batches:
            for page_id, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    filesystem.create_dir(base, recursive=True)
                    path = f"{base}/part-{part.partitionId():06d}.warc.gz"
                    hidden = f"{base}/_attempt-{part.taskAttemptId()}"
                    out = filesystem.open_output_stream(hidden, compression=None)
                out.write(gzip_member(record_bytes(page_id, url, payload, refers_to, revisit), level))
                n += 1
        if out is not None:
            out.close()
            if filesystem.get_file_info(path).type != pafs.FileType.NotFound:
                filesystem.delete_file(path)  # of an earlier attempt
            filesystem.move(hidden, path)
            name = f"{folder.rstrip('/')}/part-{part.partitionId():06d}.warc.gz"
            yield pa.RecordBatch.from_pydict({"archive": [name], "n_records": [n]})

    return records.select("page_id", "url", "payload", "revisit", "refers_to").mapInArrow(
        save, "archive string, n_records long")


def read_warc(spark: SparkSession, archives: list[str] | DataFrame, with_payload: bool = True,
              batch_bytes: int = 8 << 20) -> DataFrame:
    """Records of archives (a list of paths, or a frame whose first column
    holds them), each read from start to end by one task.  Raises where a
    member is cut off, a frame is wrong or a digest differs."""
    paths = archives if isinstance(archives, DataFrame) else spark.createDataFrame([(a,) for a in archives], "archive string")
    names = ["archive", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    schema = pa.schema([("archive", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("payload", pa.binary())])

    def load(batches):
        rows, held = [], 0
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                filesystem, path = _open(archive)
                with filesystem.open_input_stream(path, compression=None) as stream:
                    for data in members(stream):
                        r = parse_record(data) | {"archive": archive}
                        if not with_payload:
                            r["payload"] = None
                        rows.append(r)
                        held += 200 + len(r["payload"] or b"")
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return paths.select(paths.columns[0]).mapInArrow(load, RECORD_SCHEMA).select(*names)


def archive_pages(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives below ``folder`` (the
    shared checkpoint folder unless given) and read every record back.

    A null html is an empty payload, a null url ``about:blank``, a null
    page_id stays null; an empty table writes no archive and gives no rows.
    Other columns of ``pages`` are not read."""
    spark = pages.sparkSession
    folder = folder or stage_path(spark, "warc")
    written = write_warc(deduplicate(pages, min_bytes), folder).collect()  # a row for each archive
    paths = [r["archive"] for r in written]
    if not paths:
        return spark.createDataFrame([], RECORD_SCHEMA)
    listed = spark.createDataFrame([(p,) for p in paths], "archive string").repartition(len(paths))
    return read_warc(spark, listed, with_payload=False)
