"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent frames of about ``FRAME`` bytes; a bundle
ends in a skippable frame with the seek table of the public seekable format
(sizes of every frame, their number, a descriptor byte and a magic number), so
that any Zstandard reader decompresses it as one stream and a seeking reader
reads one frame. An index maps each record to its bundle, frame and offset in
the frame.

Of records with equal payloads (of at least ``min_bytes`` bytes) the one with the
smallest page id is a response record with its payload; the others are revisit
records, which name it and hold none.

Each task writes its bundle under a name of its own, first as a hidden file that
is renamed when it is complete, and returns what it wrote, so that a lost or
repeated task leaves at most an orphan file that no index names. One frame is
held in memory. Duplicates are found from digests; the pages themselves are
dealt out once, by digest, and meet one row for each payload that occurs again,
so that a payload which a third of all pages share can be split among tasks.

Edge cases: a null html is an empty payload; a null page id is written as
"null", counts as larger than any other and, where every equal payload has a
null id, as a response. Pages that share an id and a payload are responses all,
if the id is the smallest. Extra columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import make_folder, new_path, qualified, written

FRAME = 1 << 20
BUNDLE = 256 << 20
LEVEL = 6
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id bigint, bundle string, frame int, frame_start bigint, frame_bytes bigint, offset bigint, length bigint, record_type string"
_DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit's block is the HTTP head only; its payload's
    length goes into the head, where HTTP has it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, start: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at ``start``."""
    stop = data.index(b"\r\n\r\n", start)
    lines = data[start:stop].decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {start}")
    block = data[stop + 4 : stop + 4 + int(headers["Content-Length"])]
    return headers, block, stop + 4 + len(block) + 4


class BundleWriter:
    """Writes frames and, on close, the seek table."""

    def __init__(self, out):
        self.out, self.frames, self.at, self.compressor = out, [], 0, zstandard.ZstdCompressor(level=LEVEL)

    def frame(self, data: bytes) -> tuple[int, int, int]:
        """(number, start, bytes) of the frame that now holds ``data``."""
        packed = self.compressor.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data)))
        where = len(self.frames) - 1, self.at, len(packed)
        self.at += len(packed)
        return where

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed bytes, bytes) of each frame, from the footer alone."""
    size = file.seek(0, io.SEEK_END)
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * n)
    raw, start, out = file.read(8 * n), 0, []
    for packed, plain in struct.iter_unpack("<II", raw):
        out.append((start, packed, plain))
        start += packed
    return out


def _open(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri)


def decide(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, first): first is the smallest page id of the equal
    payloads, null for those that have none to refer to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("key"))
    counted = keyed.filter(F.octet_length("payload") >= min_bytes).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # Only payloads that occur again have something to refer to. A payload that a
    # third of all pages share is split by adaptive execution: the written side has
    # one row for it.
    again = written(spark, counted.filter("n > 1 and first is not null").select("key", "first"), "again")
    return keyed.join(again, "key", "left").select("page_id", "url", "payload", "first")


def write(spark: SparkSession, pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Writes one record for each page and returns the index (a written table,
    columns ``INDEX``)."""
    folder = qualified(spark, folder or new_path(spark, "warc"))
    make_folder(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        # Also here: a file system whose folders are a machine's own view of a store.
        fs.create_dir(base, recursive=True)
        state = None

        def start():
            name = f"{uuid.uuid4().hex}.warc.zst"
            out = fs.open_output_stream(f"{base}/.{name}", compression=None)
            return name, out, BundleWriter(out)

        def flush(frame: list, rows: list):
            number, at, size = state[2].frame(b"".join(frame))
            return [(*r[:1], f"{folder}/{state[0]}", number, at, size, *r[1:]) for r in rows]

        def finish():
            name, out, writer = state
            writer.close()
            out.close()
            fs.move(f"{base}/.{name}", f"{base}/{name}")

        frame, rows, held, done = [], [], 0, []
        for batch in batches:
            for row in batch.to_pylist():
                revisit = row["first"] is not None and row["page_id"] != row["first"]
                data = record(row["page_id"], row["url"], row["payload"], row["first"], revisit)
                state = state or start()
                rows.append((row["page_id"], held, len(data), "revisit" if revisit else "response"))
                frame.append(data)
                held += len(data)
                if held >= FRAME:
                    done += flush(frame, rows)
                    frame, rows, held = [], [], 0
                    if state[2].at >= BUNDLE:
                        finish()
                        state = None
                        yield _batch(done)
                        done = []
        if state is not None:
            if frame:
                done += flush(frame, rows)
            finish()
        if done:
            yield _batch(done)

    return written(spark, decide(spark, pages, min_bytes).mapInArrow(run, INDEX), "warc-index")


_INDEX = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("frame_start", pa.int64()), ("frame_bytes", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _INDEX.types, strict=True)], schema=_INDEX)


def read_record(entry) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, from its frame alone. ``entry``: a row of
    the index."""
    fs, path = _open(entry["bundle"])
    with fs.open_input_file(path) as file:
        file.seek(entry["frame_start"])
        data = zstandard.ZstdDecompressor().decompress(file.read(entry["frame_bytes"]))
    headers, block, _ = parse(data, entry["offset"])
    return headers, block


def read(index: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every
    record of the bundles that ``index`` names, read frame by frame. A response's
    length and digest are those of the payload that was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch.column(0).to_pylist():
                fs, path = _open(bundle)
                with fs.open_input_file(path) as file:
                    for start, packed, _ in seek_table(file):
                        file.seek(start)
                        data, at, rows = zstandard.ZstdDecompressor().decompress(file.read(packed)), 0, []
                        while at < len(data):
                            headers, block, at = parse(data, at)
                            rows.append(_row(headers, block))
                        columns = list(zip(*rows, strict=True))
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _READ.types, strict=True)], schema=_READ)

    # A number of partitions that adaptive execution keeps: bundles are few rows but much to read.
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bundles = index.select("bundle").distinct().repartition(parts)
    return bundles.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _id(urn: str | None) -> int | None:
    tail = urn[len("<urn:page:") : -1] if urn else "null"
    return None if tail == "null" else int(tail)


def _row(headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, named = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])[b"Content-Length"])
    if kind == "response" and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"{headers['WARC-Record-ID']}: its payload is damaged")
    return _id(headers["WARC-Record-ID"]), size, named, kind, _id(headers.get("WARC-Refers-To"))
