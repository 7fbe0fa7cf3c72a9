"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames of about a megabyte of records each, and, in a
skippable frame at its end, the seek table of the public seekable format. The index, a Parquet
table, maps every record to its bundle, its frame and its place inside the decompressed frame, so
that one record costs one frame.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEAST_REVISIT = 100
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# The seekable format's numbers, and the profile of a revisit by payload digest.
SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id STRING, page_id BIGINT, record_type STRING, bundle STRING, frame INT, offset BIGINT, length BIGINT"
RECORD = "page_id BIGINT, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to BIGINT, payload BINARY"


def urn(page_id: int | None) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}"


def page_of(record_id: str | None) -> int | None:
    number = (record_id or "").strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> tuple[str, bytes]:
    """(record type, record). A revisit holds the response's HTTP header but not its payload."""
    revisit = first is not None and first != page_id
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or urn(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    header = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{urn(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        header += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{urn(first)}>"]
    header += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return header[1].split()[1], "\r\n".join(header).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(header fields, block, end) of the record that starts at `at`."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    start, size = end + 4, int(fields["Content-Length"])
    if data[start + size : start + size + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut off")
    return fields, data[start : start + size], start + size + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The seekable format's table of (compressed, decompressed) frame sizes, as a skippable frame."""
    entries = b"".join(struct.pack("<II", *pair) for pair in sizes)
    content = entries + struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(content)) + content


def read_seek_table(file) -> list[tuple[int, int]]:
    """(offset, compressed size) of every frame of an open bundle."""
    end = file.size()
    count, descriptor, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    entry = 12 if descriptor & 0x80 else 8
    table = file.read_at(entry * count, end - 9 - entry * count)
    frames, at = [], 0
    for k in range(count):
        size = struct.unpack_from("<I", table, entry * k)[0]
        frames.append((at, size))
        at += size
    return frames


@dataclass
class Bundle:
    """A bundle being written: records gather into a frame, frames into the file."""

    files: pafs.FileSystem
    path: str
    name: str
    frame_bytes: int = FRAME_BYTES
    sizes: list[tuple[int, int]] = field(default_factory=list)
    written: int = 0

    def __post_init__(self) -> None:
        self.stream = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None)
        self.parts: list[bytes] = []
        self.filled = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the record."""
        if self.filled and self.filled + len(record) > self.frame_bytes:
            self.end_frame()
        place = len(self.sizes), self.filled
        self.parts.append(record)
        self.filled += len(record)
        return place

    def end_frame(self) -> None:
        data = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(b"".join(self.parts))
        self.stream.write(data)
        self.sizes.append((len(data), self.filled))
        self.written += len(data)
        self.parts, self.filled = [], 0

    def close(self) -> None:
        if self.filled:
            self.end_frame()
        self.stream.write(seek_table(self.sizes))
        self.stream.close()


def writer(folder: str, frame_bytes: int, bundle_bytes: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        # each attempt has names of its own; those of one that fails never enter the index
        stem = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        files, path = pafs.FileSystem.from_uri(f"{folder}/data")
        bundle, count = None, 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                kind, record = record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["first"])
                if bundle is None:
                    files.create_dir(path)
                    bundle = Bundle(files, path, f"{stem}-{count}.warc.zst", frame_bytes)
                    count += 1
                frame, offset = bundle.add(record)
                rows.append((f"<{urn(row['page_id'])}>", row["page_id"], kind, bundle.name, frame, offset, len(record)))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [p.split()[0] for p in INDEX.split(", ")]
            )
        if bundle is not None:
            bundle.close()

    return write


def write_archive(
    pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Write a record per row of `pages` (page_id BIGINT, url STRING, html STRING, more ignored); returns the index.

    The payload is the html in UTF-8; null is empty. Of records with equal payloads of at least 100
    bytes the one with the smallest page_id is a response and the others revisit it; smaller ones
    are all responses. Rows that repeat that page_id with the same payload are responses too. A row
    without a page_id revisits if it can and has a record id without a number. A null url becomes
    the record id. Records longer than a frame have one of their own. An empty table gives an
    empty index and no bundle.

    Digests are combined before the shuffle; a payload that a third of the rows share is a hot key
    of the join only, which AQE splits. Bundles are written to `folder`, which all executors must
    reach, and count once the index names them.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= LEAST_REVISIT)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    placed = rows.join(firsts.hint("shuffle_hash"), "digest", "left")
    index = placed.select("page_id", "url", "payload", "digest", "first").mapInArrow(
        writer(folder, frame_bytes, bundle_bytes), INDEX
    )
    index.write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def to_rows(records: Iterable[tuple[dict[str, str], bytes]], with_payload: bool) -> pa.RecordBatch:
    """Records as columns; what a response says of its payload is checked."""
    out = []
    for fields, block in records:
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"(?mi)^Content-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = fields["WARC-Type"]
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
        kept = payload if with_payload and kind == "response" else None
        out.append((page_of(fields["WARC-Record-ID"]), size, digest, kind, page_of(fields.get("WARC-Refers-To")), kept))
    columns = list(zip(*out, strict=True)) or [()] * 6
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [p.split()[0] for p in RECORD.split(", ")]
    )


def reader(folder: str, with_payload: bool):
    """Reads (bundle, frame, offsets): all records of the frame, or those at the offsets."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pafs.FileSystem.from_uri(f"{folder}/data")
        name, file, frames = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    name = row["bundle"]
                    file = files.open_input_file(f"{path}/{name}")
                    frames = read_seek_table(file)
                at, size = frames[row["frame"]]
                data = zstandard.ZstdDecompressor().decompress(file.read_at(size, at))
                yield to_rows(frame_records(data, row["offsets"]), with_payload)

    return read


def frame_records(data: bytes, offsets: list[int] | None) -> Iterator[tuple[dict[str, str], bytes]]:
    if offsets is None:
        at = 0
        while at < len(data):
            fields, block, at = parse_record(data, at)
            yield fields, block
    else:
        for at in offsets:
            yield parse_record(data, at)[:2]


def read_archive(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of every record, by frames.

    payload is null for revisits, and for all records unless asked for.
    """
    frames = read_index(spark, folder).select("bundle", "frame").distinct()
    work = frames.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame")
    return work.withColumn("offsets", F.lit(None).cast("array<bigint>")).mapInArrow(reader(folder, with_payload), RECORD)


def read_records(spark: SparkSession, folder: str, record_ids: DataFrame) -> DataFrame:
    """The records named in record_ids (record_id STRING), like read_archive with payloads; reads only their frames."""
    places = read_index(spark, folder).join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    work = places.groupBy("bundle", "frame").agg(F.array_sort(F.collect_list("offset")).alias("offsets"))
    return work.mapInArrow(reader(folder, True), RECORD)
