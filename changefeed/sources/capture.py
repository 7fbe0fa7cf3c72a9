"""Captured server-sent-event files to events."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefeed.session import checkpointed, ship_package

# The line names that mean something, and the name of an event that has none.
FIELDS = ("data", "event", "id", "retry")
DEFAULT_EVENT = "message"

FIELDS_OF_PIECE = "event: STRING, data: STRING, id: STRING, retry_ms: INT"
BLOCK = "file STRING, split BIGINT, piece BIGINT, event STRING, data STRING, id STRING, retry_ms INT"
ENDS = (
    "file STRING, split BIGINT, size BIGINT, modified TIMESTAMP, blanks BIGINT, "
    f"head STRUCT<{FIELDS_OF_PIECE}>, tail STRUCT<{FIELDS_OF_PIECE}>"
)
WHOLE_NUMBER = re.compile(r"[\x00-\x20]*([+-]?[0-9]+)[\x00-\x20]*", re.ASCII)


def read_capture(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of all capture files; large files are read in splits, CR, LF or both end a line."""
    return place_lines(spark.read.text(path).select("value", "_metadata"))


def place_lines(lines: DataFrame) -> DataFrame:
    """Each line with its file, the byte at which its split starts, and the file's size and time. Lines stay in
    the order in which a task reads them."""
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("value").alias("line"),
    )


def split_ends(lines: DataFrame) -> DataFrame:
    """One small row per split, stored: file, split, size, modified, blanks, blanks_before, file_blanks, head, tail.

    `blanks` are the split's blank lines, `blanks_before` those in earlier splits of the file,
    `file_blanks` those of all of it. `head` is what stands before the first blank line of a split
    that does not start its file, `tail` what stands behind the last one. Being stored, the table's size is
    known when it is joined, so Spark sends it to all tasks only while it is small.
    """
    ship_package(lines.sparkSession)
    file = Window.partitionBy("file")
    earlier = file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ends = lines.mapInArrow(read_ends, ENDS)
    before = F.coalesce(F.sum("blanks").over(earlier), F.lit(0))
    return checkpointed(ends.select("*", before.alias("blanks_before"), F.sum("blanks").over(file).alias("file_blanks")))


def sse_blocks(lines: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """One row per block closed by a blank line: file, block_no, event, data, id, retry_ms.

    `block_no` is the number of blank lines before the block in its file, whatever the splits. The
    data lines of a block are joined with newlines; of every other field the last line wins.

    A task that reads a split puts its blocks together as the lines come, so those that lie inside a
    split are never shuffled or sorted, nor is a split, such as a compressed capture, held in memory.
    Only the two ends of each split, which a first pass has stored, are put together with those of
    their neighbours; lines behind a file's last blank line go before that.

    ends: of the same lines, from `split_ends`, where they are known already.
    """
    ends = split_ends(lines) if ends is None else ends
    starts = ends.select("file", "split", "blanks_before")
    inside = lines.select("file", "split", "line").mapInArrow(read_blocks, BLOCK).join(starts, ["file", "split"])
    inside = inside.select("file", (F.col("blanks_before") + F.col("piece")).alias("block_no"), "event", "data", "id", "retry_ms")

    head = F.struct(F.col("blanks_before").alias("block_no"), F.col("head").alias("part"))
    tail = F.struct((F.col("blanks_before") + F.col("blanks")).alias("block_no"), F.col("tail").alias("part"))
    parts = ends.select("file", "split", "file_blanks", F.inline(F.array(head, tail))).where("part is not null")
    data = F.when(F.col("part.data").isNotNull(), F.struct("split", F.col("part.data").alias("data")))

    def last_of(name: str) -> Column:
        value = F.col(f"part.{name}")
        return F.max_by(value, F.when(value.isNotNull(), F.col("split"))).alias(name)

    joined = (
        parts.where("block_no < file_blanks")
        .groupBy("file", "block_no")
        .agg(
            last_of("event"),
            F.array_join(F.sort_array(F.collect_list(data)).getField("data"), "\n").alias("data"),
            last_of("id"),
            last_of("retry_ms"),
        )
    )
    return joined.unionByName(inside).withColumn("event", F.coalesce("event", F.lit(DEFAULT_EVENT)))


@dataclass
class Piece:
    """The fields of a block, as far as its lines have been read."""

    fields: dict[str, str] = field(default_factory=dict)
    data: list[str] = field(default_factory=list)
    retry_ms: int | None = None

    def add(self, line: str) -> None:
        """Take a `name:value` line without one leading space of the value; comments and other names mean nothing."""
        name, _, value = line.partition(":")
        value = value.removeprefix(" ")
        if name == "data":
            self.data.append(value)
        elif name == "retry":
            number = WHOLE_NUMBER.fullmatch(value)
            if number and -(1 << 31) <= int(number[1]) < 1 << 31:
                self.retry_ms = int(number[1])
        elif name in FIELDS:
            self.fields[name] = value

    def part(self) -> dict:
        data = "\n".join(self.data) if self.data else None
        return {"event": self.fields.get("event"), "data": data, "id": self.fields.get("id"), "retry_ms": self.retry_ms}


def split_slices(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """(file, split) and the rows of the batch that lie in it, in order."""
    if not len(batch):
        return
    files = batch.column("file").dictionary_encode()
    codes, splits = files.indices.to_numpy(), batch.column("split").to_numpy()
    bounds = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(splits) != 0)) + 1).tolist(), len(batch)]
    for begin, end in zip(bounds, bounds[1:], strict=False):
        yield (files.dictionary[int(codes[begin])].as_py(), int(splits[begin])), begin, end


def read_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks that begin and end in one split, from lines in the order in which they are read."""
    names = [column.split()[0] for column in BLOCK.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32()]
    place: tuple[str, int] | None = None
    piece, number, begun = Piece(), 0, False
    for batch in batches:
        rows: list[tuple] = []
        for here, begin, end in split_slices(batch):
            if here != place:
                place, piece, number, begun = here, Piece(), 0, here[1] == 0
            for line in batch.column("line").slice(begin, end - begin).to_pylist():
                if line:
                    if begun:
                        piece.add(line)
                    continue
                if begun:
                    data = "\n".join(piece.data)
                    rows.append((*place, number, piece.fields.get("event"), data, piece.fields.get("id"), piece.retry_ms))
                    piece = Piece()
                number, begun = number + 1, True
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def read_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split, from lines in the order in which they are read; only lines at the ends are looked into."""
    place: tuple[str, int] | None = None
    about: list = []
    head, tail, blanks = Piece(), Piece(), 0

    def row() -> pa.RecordBatch:
        part = pa.struct([("event", pa.string()), ("data", pa.string()), ("id", pa.string()), ("retry_ms", pa.int32())])
        first = head.part() if blanks and place[1] else None
        last = (tail if blanks else head).part()
        ends = [pa.array([first], part), pa.array([last], part)]
        return pa.RecordBatch.from_arrays([*about, pa.array([blanks]), *ends], [column.split()[0] for column in re.split(", (?=[a-z]+ [A-Z])", ENDS)])

    for batch in batches:
        for here, begin, end in split_slices(batch):
            if here != place:
                if place is not None:
                    yield row()
                place, about = here, [batch.column(name).slice(begin, 1) for name in ("file", "split", "size", "modified")]
                head, tail, blanks = Piece(), Piece(), 0
            lines = batch.column("line").slice(begin, end - begin)
            blank = np.flatnonzero(pc.equal(lines, "").to_numpy(zero_copy_only=False))
            first, last = (int(blank[0]), int(blank[-1]) + 1) if len(blank) else (len(lines), 0)
            if not blanks:
                for line in lines.slice(0, first).to_pylist():
                    head.add(line)
            if len(blank):
                tail = Piece()
            if blanks or len(blank):
                for line in lines.slice(last).to_pylist():
                    tail.add(line)
            blanks += len(blank)
    if place is not None:
        yield row()


def sse_events(blocks: DataFrame) -> DataFrame:
    """Blocks that carry data; comments, keep-alives and bare ids are no events."""
    return blocks.where(F.col("data") != "")


def resume_position(blocks: DataFrame) -> DataFrame:
    """The last non-empty id, whether or not its block was an event.

    File names must sort in the order of capture.
    """
    return blocks.where(F.col("id") != "").agg(
        F.max_by("id", F.struct("file", "block_no")).alias("last_event_id")
    )
