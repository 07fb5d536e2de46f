"""WARC archives as seekable Zstandard bundles.

Each task writes its records in bundles: records are grouped into independent
Zstandard frames, and a skippable frame with a seek table ends the file, so any
frame can be read alone. The manifest maps a record to its bundle, its frame and its
offset in the frame. A task that runs again writes files under other names, and only
the files that the manifest names count, so a lost executor leaves no wrong record.

Of records with equal payloads of a minimum size, the one with the largest id is the
response and the others revisit it without a payload.

Defined cases: null payloads are empty; null ids are written with the id 'null' and
come before all others; a row that repeats an id is written again with the same
type; other columns are ignored; an empty table gives no bundle
and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Uncompressed bytes after which a frame ends, and compressed bytes after which a bundle ends.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
LEVEL = 3
#: Payloads of fewer bytes are always responses.
MIN_REVISIT = 0
#: Of the seekable format: magic of the skippable frame and of the footer (fixed values).
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Bytes of the footer and of an entry of the seek table (fixed by the format).
FOOTER, ENTRY = 9, 8
#: Bytes of frames that a task reads.
READ_BYTES = 32 << 20
MANIFEST = "page_id long, bundle string, frame_start long, frame_bytes long, record_offset long, record_bytes long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, payload_digest: str, payload_bytes: int, refers_to: int | None) -> bytes:
    """A WARC/1.1 record; a revisit has no block."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Target-URI: {url}", "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{payload_digest}", f"X-Payload-Length: {payload_bytes}", "Content-Type: text/html; charset=utf-8",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    return "\r\n".join([*head, f"Content-Length: {len(payload)}", "", ""]).encode() + payload + b"\r\n\r\n"


def parsed(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at a place in a frame."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, data[start:stop], stop + 4


class BundleWriter:
    """A seekable file of independent frames."""

    def __init__(self, out):
        self.out, self.frames, self.size = out, [], 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def frame(self, data: bytes) -> tuple[int, int]:
        """Writes a frame: its (start, bytes)."""
        packed = self.compressor.compress(data)
        start = self.size
        self.out.write(packed)
        self.size += len(packed)
        self.frames.append((len(packed), len(data)))
        return start, len(packed)

    def close(self) -> None:
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.frames), 0, SEEKABLE))
        self.out.close()


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed bytes, bytes) of each frame, from the end of a bundle."""
    n, _, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    out, start = [], 0
    for packed, size in struct.iter_unpack("<II", data[-9 - 8 * n : -9]):
        out.append((start, packed, size))
        start += packed
    return out


def file_system(uri: str):
    """(pyarrow file system, path) of a folder; a plain path is a local one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def folder(spark) -> str:
    """A new folder for bundles in the shared place, as a URI that pyarrow opens; a path without a scheme is one of Spark's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(common.scratch(spark))
    path = str(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


class BundleReader:
    """The bundles of a folder, one open at a time; frames are found by the seek table at a bundle's end."""

    def __init__(self, where: str):
        self.fs, self.base = file_system(where)
        self.name, self.file, self.frames = "", None, {}

    def frame(self, bundle: str, start: int, size: int) -> bytes:
        """The bytes of the frame at a place; it is an error if the seek table has no frame of that size there."""
        if bundle != self.name:
            self.close()
            self.name, self.file = bundle, self.fs.open_input_file(f"{self.base}/{bundle}")
            end = self.file.size()
            n = struct.unpack("<IBI", self.file.read_at(FOOTER, end - FOOTER))[0]
            table = seek_table(self.file.read_at(FOOTER + ENTRY * n, end - FOOTER - ENTRY * n))
            self.frames = {at: (packed, whole) for at, packed, whole in table}
        packed, whole = self.frames.get(start, (None, None))
        if packed != size:
            raise ValueError(f"{bundle}: the seek table has no frame of {size} bytes at {start}")
        data = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, start))
        if len(data) != whole:
            raise ValueError(f"{bundle}: the frame at {start} has {len(data)} bytes, not {whole}")
        return data

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def targets(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, sha1, refers_to) of each distinct page and payload.

    Payloads are known by their digests from here on; a digest in many pages is
    reduced map-side to its largest id.
    """
    known = common.saved(pages.select("page_id", F.sha1("data").alias("sha1"), F.length("data").cast("long").alias("bytes")))
    response = known.groupBy("sha1", "bytes").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).filter((F.col("n") > 1) & (F.col("bytes") >= min_bytes))
    response = common.saved(response.select("sha1", "top"))
    return common.join_small(known, response, "sha1", "left").filter("top is not null and not (page_id <=> top)").select("page_id", "sha1", F.col("top").alias("refers_to")).distinct()


def write(pages: DataFrame, where: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_REVISIT, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes bundles under where; the manifest, as a written table."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), common.text_bytes(html).alias("data"))
    revisits = common.saved(targets(rows, min_bytes))
    n = revisits.count()
    rows = rows.withColumn("sha1", F.sha1("data")) if n else rows.withColumn("refers_to", F.lit(None).cast("long"))
    if n:
        own = common.join_small(rows, revisits.withColumnRenamed("page_id", "id"), (rows.page_id.eqNullSafe(F.col("id"))) & (rows.sha1 == revisits.sha1), "left", n)
        rows = own.select("page_id", "url", "data", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(where)
        writer, name, buffer, waiting = None, "", io.BytesIO(), []

        def flush() -> pa.RecordBatch:
            start, size = writer.frame(buffer.getvalue())
            columns = list(zip(*waiting, strict=True))
            arrays = [pa.array(columns[0], pa.int64()), pa.array([name] * len(waiting)), *(pa.array([x] * len(waiting), pa.int64()) for x in (start, size)), *(pa.array(c, pa.int64()) for c in columns[1:])]
            buffer.seek(0)
            buffer.truncate()
            waiting.clear()
            return pa.RecordBatch.from_arrays(arrays, ["page_id", "bundle", "frame_start", "frame_bytes", "record_offset", "record_bytes"])

        for batch in batches:
            for key, address, data, other in zip(*(batch.column(c) for c in ("page_id", "url", "data", "refers_to")), strict=True):
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(fs.open_output_stream(f"{base}/{name}", compression=None))
                payload, at = data.as_py(), buffer.tell()
                buffer.write(record(key.as_py(), address.as_py().replace("\r", "%0D").replace("\n", "%0A"), payload, digest(payload), len(payload), other.as_py()))
                waiting.append((key.as_py(), at, buffer.tell() - at))
                if buffer.tell() >= frame_bytes:
                    yield flush()
                    if writer.size >= bundle_bytes:
                        writer.close()
                        writer = None
        if writer is not None:
            if waiting:
                yield flush()
            writer.close()

    return common.saved(rows.mapInArrow(run, MANIFEST))


def read(manifest: DataFrame, where: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the manifest's records, from their bundles.

    A response's bytes and digest are taken from its block, a revisit's from its headers.
    Tasks are dealt by the bytes of their frames, not by those of the manifest.
    """
    frames = manifest.groupBy("bundle", "frame_start", "frame_bytes").agg(F.collect_list("record_offset").alias("offsets"))  # bounded by a frame's records
    frames = common.saved(frames)
    total = frames.agg(F.sum("frame_bytes")).first()[0] or 0
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, total // READ_BYTES)
    frames = frames.repartition(int(tasks), "bundle", "frame_start").sortWithinPartitions("bundle", "frame_start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = BundleReader(where)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for row in batch.to_pylist():
                data = reader.frame(row["bundle"], row["frame_start"], row["frame_bytes"])
                out = []
                for at in row["offsets"]:
                    headers, block, _ = parsed(data, at)
                    own = headers["WARC-Record-ID"][10:-1]
                    if headers["WARC-Type"] == "response":
                        got = (len(block), digest(block), "response", None)
                    else:
                        other = headers["WARC-Refers-To"][10:-1]
                        got = (int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:"), "revisit", int(other))
                    out.append((None if own == "null" else int(own), *got))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names)
        reader.close()

    return frames.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def payload(manifest_row, where: str) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record by its manifest row: one ranged read and one frame."""
    reader = BundleReader(where)
    data = reader.frame(manifest_row["bundle"], manifest_row["frame_start"], manifest_row["frame_bytes"])
    reader.close()
    return parsed(data, manifest_row["record_offset"])[:2]


SQL = r"""
WITH page AS (SELECT page_id, encode(coalesce(html, '')) AS data FROM pages),
known AS (SELECT page_id, octet_length(data) AS payload_bytes, sha1(data) AS hex FROM page),
top AS (SELECT hex, max(page_id) AS top FROM known WHERE payload_bytes >= {min_bytes} GROUP BY hex),
bits AS (
  SELECT page_id, payload_bytes, hex, top, CASE WHEN top IS NOT NULL AND top <> page_id THEN top END AS refers_to FROM known LEFT JOIN top USING (hex))
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(hex || '0', 1 + CAST(floor(5 * i / 4) AS BIGINT), 2) AS INT) >> (3 - (5 * i) % 4)) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM bits
"""


def oracle() -> str:
    return SQL.replace("{min_bytes}", str(MIN_REVISIT))
