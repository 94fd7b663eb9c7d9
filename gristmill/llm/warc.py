"""WARC archives: a writer of one gzip member a record, and a splittable reader.

The reader deals byte ranges of the archives to tasks. A task looks for gzip magic in its range, takes a place as a member
if its start decodes to a WARC header, and owns the records that start inside its range; the last one may end beyond it.
So one large archive is read by many tasks, whatever the place of its members.

Of records with equal payloads the one with the largest page_id is a response and holds the payload; others are revisits
of it and hold only headers. Payloads below least_bytes are always responses.

Defined results: null html counts as empty; null page_id comes back as null and counts as the smallest; rows that repeat
id, url and payload of the response are responses too; a null url is left out. Payloads of any length are whole: a member may be
longer than a range. Other columns, whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import save, shared_dir

MAGIC = b"\x1f\x8b\x08"
#: Bytes of an archive after which a writer begins another, and of the range that a reader's task scans.
ARCHIVE_BYTES, RANGE_BYTES = 256 << 20, 4 << 20
#: Ranges that a reading task is given, and tasks at most: beyond that each gets more ranges.
TASK_RANGES, MOST_TASKS = 4, 50_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _record(page_id: int | None, url: str | None, html: str, refers_to: int | None, revisit: bool) -> bytes:
    payload = html.encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = lambda x: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{x}')}>"
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}"] if url is not None else []
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    head += [f"WARC-Page-Id: {page_id}"] if page_id is not None else []
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"] + ([f"WARC-Refers-To-Page-Id: {refers_to}"] if refers_to is not None else [])
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write pages (page_id, url, html) as archives into folder; returns their (path, bytes), itself a written table.

    A task writes under a name of its attempt and renames at its end, so that a repeated task leaves one archive.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    best = rows.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("best"))
    short = F.octet_length("html") < least_bytes
    typed = rows.join(best, "digest").withColumn("revisit", ~short & ~F.struct("page_id", "url").eqNullSafe(F.col("best"))).select("page_id", "url", "html", F.col("best.page_id").alias("refers_to"), "revisit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, top = _open(folder)
        files.create_dir(top)
        part, k, out, done, size = context.partitionId(), 0, None, [], 0

        def close() -> None:
            out.close()
            path = f"{top}/part-{part:06d}-{k:04d}.warc.gz"
            files.move(f"{path}.{context.taskAttemptId()}", path)
            done.append((path.rpartition("/")[2], size))

        for batch in batches:
            for at in range(batch.num_rows):
                if out is None:
                    out, size = files.open_output_stream(f"{top}/part-{part:06d}-{k:04d}.warc.gz.{context.taskAttemptId()}"), 0
                data = _record(*(batch.column(c)[at].as_py() for c in range(5)))
                out.write(data)
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    close()
                    out, k = None, k + 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], ["name", "bytes"])

    made = save(typed.mapInArrow(run, "name string, bytes long"), f"{folder}-list")
    return made.select(F.concat(F.lit(f"{folder}/"), "name").alias("path"), "bytes")


def _member(source: pa.NativeFile, buffer: bytes, start: int, place: int) -> tuple[bytes, int] | None:
    """The decoded member at a place and where it ends; None if it isn't one. buffer holds the bytes from start on."""
    decode, out, piece = zlib.decompressobj(31), [], 512
    try:
        while not decode.eof:
            data = buffer[place - start : place - start + piece]
            if len(data) < piece:  # the member goes on beyond the range
                source.seek(place)
                data = source.read(piece)
                if not data:
                    return None
            place += len(data)
            out.append(decode.decompress(data))
            if piece == 512 and not out[0].startswith(b"WARC/"):
                return None
            piece = 1 << 16
    except zlib.error:
        return None
    return b"".join(out), place - len(decode.unused_data)


def records(source: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """The decoded records that start in [start, end) of an archive."""
    source.seek(start)
    buffer = source.read(end - start + len(MAGIC) - 1)
    at = buffer.find(MAGIC)
    while 0 <= at < end - start:
        found = _member(source, buffer, start, start + at)
        if found:
            yield found[0]
        at = buffer.find(MAGIC, found[1] - start if found else at + 1)


def _fields(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    named = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(named["Content-Length"])]
    number = lambda k: int(named[k]) if k in named else None
    if named["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        length, digest, html = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), payload.decode()
    else:
        length, digest, html = number("WARC-Payload-Length"), named["WARC-Payload-Digest"].removeprefix("sha1:"), None
    return number("WARC-Page-Id"), named.get("WARC-Target-URI"), length, digest, named["WARC-Type"], number("WARC-Refers-To-Page-Id"), html


def read(archives: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of archives (path, bytes): page_id, url, payload_bytes, payload_digest, record_type, refers_to, html.

    Digest and length of a response come from the payload that was read; html is null for revisits.
    """
    ranges = archives.where("bytes > 0").withColumn("start", F.explode(F.expr(f"sequence(0L, bytes - 1, {range_bytes}L)")))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, "bytes").alias("end"))
    # rows of ranges are tiny, so Spark can't tell from their size how much work they are: the number of tasks is stated
    some = archives.agg(F.sum(F.ceil(F.col("bytes") / range_bytes)).alias("n")).first().n or 0
    ranges = ranges.repartition(min(MOST_TASKS, max(1, -(-some // TASK_RANGES))), "path", "start")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts:
            for path, start, end in zip(*(p.column(c).to_pylist() for c in range(3)), strict=True):
                files, at = _open(path)
                with files.open_input_file(at) as source:
                    rows, held = [], 0
                    for record in records(source, start, end):
                        rows.append(_fields(record)[: 7 if payloads else 6] + (() if payloads else (None,)))
                        held += len(record)
                        if held > 4 << 20:
                            yield _batch(rows, names)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names)

    return ranges.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages as archives in the shared folder and read them back."""
    folder = shared_dir(pages.sparkSession, "warc")
    return read(write(pages, folder, least_bytes), payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
