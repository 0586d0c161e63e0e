"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames of about a megabyte, each an independent Zstandard
frame; a bundle ends with a seek table in a skippable frame (compressed and
decompressed size of each frame, then the number of frames and a magic number).
An index maps each record identifier to bundle, frame, and the offset within
the decompressed frame, so one record is read by one seek and one frame.

Tasks write bundles straight into the shared folder, under a name of their own
and then renamed, and return the index rows. A retried task writes other names;
only those in the committed index count.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import new_path, partitions_for, staged, table

FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 64 << 20
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
EPOCH = "2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def build_record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """A response record, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {EPOCH}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes | memoryview, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    data = bytes(data) if isinstance(data, memoryview) else data
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = {k: v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, data[start:stop], stop + 4


class BundleWriter:
    def __init__(self, out, level: int = 3):
        import zstandard

        self.out, self.zstd = out, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.size = self.total = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame number and offset within that frame."""
        if self.size and self.size + len(record) > FRAME_BYTES:
            self._frame()
        where = (len(self.frames), self.size)
        self.parts.append(record)
        self.size += len(record)
        return where

    def _frame(self) -> None:
        packed = self.zstd.compress(b"".join(self.parts))
        self.out.write(packed)
        self.frames.append((len(packed), self.size))
        self.total += len(packed)
        self.parts, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._frame()
        body = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


class BundleReader:
    """Reads the seek table from the file's end; frames in any order."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, io.SEEK_END)
        source.seek(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        entry = 12 if descriptor & 0x80 else 8
        source.seek(size - 9 - n * entry)
        table = source.read(n * entry)
        self.frames, at = [], 0
        for k in range(n):
            packed, plain = struct.unpack_from("<II", table, k * entry)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        import zstandard

        at, packed, plain = self.frames[k]
        self.source.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=plain)

    def record(self, frame: int, offset: int):
        return parse_record(self.frame(frame), offset)[:2]


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Bundles in ``folder`` of rows (page_id, url, html, refers_to, revisit); the
    index: page_id, record_id, bundle, frame, offset, length."""

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        rows: list[tuple] = []
        state: dict = {"n": 0}

        def open_bundle():
            name = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{state['n']:04d}.warc.zst"
            state["n"] += 1
            return name, BundleWriter(store.open_output_stream(name + ".tmp"))

        def close(name, w):
            w.close()
            store.move(name + ".tmp", name)

        name = writer = None
        for b in batches:
            for page_id, url, html, refers_to, revisit in zip(*(c.to_pylist() for c in b.columns)):
                payload = (html or "").encode("utf-8", "surrogatepass")
                if writer is None:
                    name, writer = open_bundle()
                record = build_record(page_id, url, payload, sha1_base32(payload), refers_to, revisit)
                rows.append((page_id, record_id(page_id), name, *writer.add(record), len(record)))
                if writer.total > BUNDLE_BYTES:
                    close(name, writer)
                    writer = None
            if writer is not None and len(rows) < 50_000:
                continue
            yield _index(rows)
            rows = []
        if writer is not None:
            close(name, writer)
        yield _index(rows)

    def _index(rows):
        types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, types)], ["page_id", "record_id", "bundle", "frame", "offset", "length"])

    return records.mapInArrow(run, "page_id long, record_id string, bundle string, frame int, offset long, length long")


def read_archives(index: DataFrame, folder: str, spread: int) -> DataFrame:
    """Every record of the bundles named in ``index``, read back frame by frame:
    page_id, url, payload_bytes, payload_digest, record_type, refers_to. A
    response's digest is computed from its payload and held against its header."""

    def run(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_file(name) as f:
                    reader = BundleReader(f)
                    for k in range(len(reader.frames)):
                        data, at, rows = reader.frame(k), 0, []
                        while at < len(data):
                            h, block, at = parse_record(data, at)
                            http, _, payload = block.partition(b"\r\n\r\n")
                            stated = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                            digest, revisit = h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"] == "revisit"
                            if not revisit and (len(payload) != stated or sha1_base32(payload) != digest):
                                raise ValueError(f"{name}: record {h['WARC-Record-ID']} is damaged")
                            rows.append((page_of(h["WARC-Record-ID"]), h.get("WARC-Target-URI"), stated, digest, h["WARC-Type"], page_of(h["WARC-Refers-To"]) if revisit else None))
                        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    bundles = index.groupBy("bundle").agg(F.count(F.lit(1)).alias("n")).select("bundle").repartition(spread)
    return bundles.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, str]:
    """Writes all pages; returns the index and the folder.

    Of equal payloads of at least ``min_bytes`` that with the largest page_id is
    the response, others revisit it. Null html is an empty payload; a null
    page_id is smaller than any other; rows that tie for the largest page_id are
    all responses. Only page_id, url and html are read.
    """
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    payload = F.coalesce("html", F.lit(""))
    keys = src.select("page_id", F.unhex(F.sha2(payload, 256)).alias("key"), F.octet_length(payload).alias("bytes")).where(F.col("bytes") >= min_bytes)
    groups = keys.groupBy("key").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = keys.join(groups, "key").where(~F.col("page_id").eqNullSafe(F.col("first"))).select(F.col("page_id").alias("__id"), F.col("key").alias("__key"), "first").distinct()
    revisits = staged(revisits, "warc-revisits")
    if revisits.limit(1).count():
        src = src.withColumn("__key0", F.unhex(F.sha2(payload, 256)))
        src = src.join(revisits, src["page_id"].eqNullSafe(revisits["__id"]) & (src["__key0"] == revisits["__key"]), "left")
        src = src.select("page_id", "url", "html", F.col("first").alias("refers_to"), F.col("__key").isNotNull().alias("revisit"))
    else:
        src = src.select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("revisit"))
    folder = new_path(pages.sparkSession, "warc")
    folder = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    return staged(write_archives(src, folder), "warc-index"), folder


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index, folder = archive(pages)
    return read_archives(index, folder, partitions_for(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""

QUERIES = {"op4_warc": op4_warc}
ORACLES = {"op4_warc": ORACLE}
