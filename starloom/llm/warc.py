"""WARC archives: a deduplicating writer and a splittable reader.

Writer: each task writes its pages as records of one gzip member each into files of its own, under the shared folder. Of equal payloads of at
least ``LEAST_REVISIT`` bytes, the page with the largest id is stored and the others revisit it. A file's name holds the task attempt, and the
written manifest of file names, not the folder, says what belongs to the archive, so files of lost or repeated attempts are never read.

Reader: files are cut into byte ranges, one row each, dealt evenly to as many tasks as there are ranges. A task scans its range for the gzip magic, takes
the first candidate whose decompressed head is a complete WARC header with a type and a length, and from there reads member after member; it owns the
records that start inside its range and reads past its end to finish the last. Reading uses the file systems of Arrow, so archives may lie in any store that it knows.

Defined results: a null html is an empty payload; a null url is left out of the record; pages without id are always responses and refer to
nothing; repeated rows of the stored page are all responses; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import read, texts
from starloom.session import materialise, scratch_path

LEAST_REVISIT = 1000
RANGE = 16 << 20
#: A task starts a new file beyond this size.
FILE_SIZE = 256 << 20
MAGIC = b"\x1f\x8b\x08"
PIECE = 1 << 18
DATE = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member. A revisit holds no payload, but its digest and length."""
    digest = hashlib.sha1(payload).digest()
    body = payload if refers_to is None else b""
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}", f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"Content-Length: {len(body)}")
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packed.flush()


def header(raw: bytes) -> dict[str, str] | None:
    """The fields of a record's header block; None if that isn't one."""
    head, ended, _ = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines if ": " in line)
    if not ended or not version.startswith("WARC/") or len(fields) < len(lines) or "WARC-Type" not in fields:
        return None
    return fields if fields.get("Content-Length", "").isdigit() else None


def parsed(raw: bytes) -> tuple:
    """page id, payload bytes, digest in hex, type, the page referred to."""
    fields = header(raw)
    if fields is None:
        raise ValueError("a record without a header")
    _, _, rest = raw.partition(b"\r\n\r\n")
    page = lambda name: int(n) if (n := fields.get(name, "")[len("<urn:page:") : -1]) else None
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    length = int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response":
        body = rest[: int(fields["Content-Length"])]
        if len(body) != length or hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"payload of record {fields['WARC-Record-ID']} is damaged")
    return page("WARC-Record-ID"), length, digest, fields["WARC-Type"], page("WARC-Refers-To")


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def decisions(pages: DataFrame) -> DataFrame:
    """Pages with ``refers_to``: the page that holds the same payload, null for those that hold their own."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    described = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"))
    long_ones = described.filter((F.col("bytes") >= LEAST_REVISIT) & F.col("page_id").isNotNull())
    groups = long_ones.groupBy("digest", "bytes").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    groups = materialise(groups, "equal-payloads")  # without it Spark couldn't split a hot payload
    joined = described.join(groups, ["digest", "bytes"], "left")
    return joined.select("page_id", "url", "html", F.when(F.col("page_id") != F.col("holder"), F.col("holder")).alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes archives of ``page_id, url, html`` into ``folder``; the manifest of files: ``path, size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _file_system(folder)
        task = TaskContext.get()
        out, size, files = None, 0, []

        def close():
            nonlocal out, size
            if out is not None:
                out.close()
                files.append((name, size))
            out, size = None, 0

        for ids, urls, bodies, refer in texts(batches, "page_id", "url", "html", "refers_to"):
            for row in zip(ids, urls, bodies, refer, strict=True):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{len(files):04d}-{task.taskAttemptId()}.warc.gz"
                    system.create_dir(top, recursive=True)
                    out = system.open_output_stream(f"{top}/{name}", compression=None)
                member = record(row[0], row[1], (row[2] or "").encode("utf-8", "replace"), row[3])
                out.write(member)
                size += len(member)
                if size >= FILE_SIZE:
                    close()
        close()
        if files:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n, _ in files]), pa.array([s for _, s in files], pa.int64())], names=["path", "size"])

    return materialise(decisions(pages).mapInArrow(run, "path string, size long"), "warc-manifest")


def members(source, start: int, end: int, size: int) -> Iterator[bytes]:
    """Contents of the WARC members of a file that start in [start, end)."""

    def at(place: int, length: int) -> bytes:
        source.seek(place)
        return source.read(min(length, size - place))

    def begins_record(place: int) -> bool:
        unpack, content = zlib.decompressobj(31), b""
        try:
            while not unpack.eof and place < size and b"\r\n\r\n" not in content:
                if content and not b"WARC/".startswith(content[:5]):
                    return False
                content += unpack.decompress(at(place, 4096))
                place += 4096
        except zlib.error:
            return False
        return header(content) is not None

    place = start
    while place < end:  # find the first member
        window = at(place, PIECE + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        if hit < 0:
            place += PIECE
            continue
        place += hit
        if place >= end:
            return
        if begins_record(place):
            break
        place += 1
    while place < end and place < size:
        unpack, content, read_to = zlib.decompressobj(31), bytearray(), place
        while not unpack.eof:
            piece = at(read_to, PIECE)
            if not piece:
                raise ValueError("archive ends within a record")
            content += unpack.decompress(piece)
            read_to += len(piece)
        yield bytes(content)
        place = read_to - len(unpack.unused_data)


def read_archives(manifest: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """Records of the files of a manifest: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))
    ranges = manifest.filter("size > 0").select("path", "size", F.explode(starts).alias("start"))
    n = manifest.agg(F.sum(F.ceil(F.col("size") / range_bytes))).first()[0] or 1
    tasks = ranges.withColumn("end", F.least(F.col("start") + range_bytes, "size")).repartition(int(n))  # given a number, Spark won't merge the small rows' tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for paths, sizes, froms, ends in texts(batches, "path", "size", "start", "end"):
            for path, size, start, end in zip(paths, sizes, froms, ends, strict=True):
                system, inner = _file_system(path)
                with system.open_input_file(inner) as source:
                    rows = []
                    for content in members(source, start, end, size):
                        rows.append(parsed(content))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return tasks.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, f"warc-{uuid.uuid4().hex[:8]}")
    return read_archives(write(read(spark, sf_dir, "pages"), folder))


ORACLE_SQL = {
    "op6_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS h FROM pages),
g AS (SELECT *, octet_length(b) AS n, max(page_id) OVER (PARTITION BY b) AS holder FROM p)
SELECT page_id::BIGINT AS page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> holder THEN holder END::BIGINT AS refers_to FROM g
""",
}
QUERIES = {"op6_warc": op6_warc}
