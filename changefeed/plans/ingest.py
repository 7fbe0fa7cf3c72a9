"""Captured feed to raw records, with counters."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from changefeed.operators import routing
from changefeed.settings import Settings
from changefeed.sources import kafka

POSITION = "file STRING, size BIGINT, modified TIMESTAMP, blocks BIGINT, whole BOOLEAN, number BIGINT"


FIRST_BYTES = 64 << 20
GROWTH = 8


def unread_files(spark: SparkSession, captures: str, positions: DataFrame) -> dict[str, int]:
    """Size by path of the capture files that hold something new: not listed among the positions, or longer since.

    Only names, times and lengths are read, and compared with the positions by a join, whatever order the
    names sort in. The files come in the order in which they are taken: by time, those of one time by
    name. The paths come to the driver, as those of any scan do.
    """
    listing = spark.read.format("binaryFile").load(captures)
    about = {"file": "file_path", "size": "file_size", "modified": "file_modification_time"}
    listing = listing.select("path", *[F.col(f"_metadata.{field}").alias(name) for name, field in about.items()])
    done = positions.where("whole").select("file", F.col("size").alias("read"))
    unread = listing.join(done, "file", "left").where("read is null or read <> size")
    found = unread.select("path", "size", "modified", "file").collect()
    return {row["path"]: row["size"] for row in sorted(found, key=lambda row: (row["modified"], row["file"].encode()))}


def growing_starts(files: dict[str, int], first_bytes: int = FIRST_BYTES) -> Iterator[list[str]]:
    """Paths of the first files, one at least, then of more and more of them until they are all.

    Each start may hold GROWTH times the bytes that the one before did not hold any more, so the reads
    of those that were not enough add little to that of the one that is.
    """
    paths, total, limit = [], 0, first_bytes
    for path, size in files.items():
        if paths and total + size > limit:
            yield [*paths]
            limit = GROWTH * (total + size)
        paths.append(path)
        total += size
    if paths:
        yield paths


def file_places(ends: DataFrame, positions: DataFrame) -> DataFrame:
    """(file, size, modified, blanks, taken, before): what each file being read holds and what has been taken of it.

    `before` is the number of new blocks in the files that come before it, by time and then by name.
    One row per file.
    """
    files = ends.groupBy("file").agg(
        F.max("size").alias("size"), F.max("modified").alias("modified"), F.max("file_blanks").alias("blanks")
    )
    files = files.join(positions.select("file", F.col("blocks").alias("taken")), "file", "left")
    files = files.withColumn("taken", F.coalesce("taken", F.lit(0)))
    earlier = Window.orderBy("modified", "file").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("blanks") - F.col("taken"), F.lit(0))
    return files.withColumn("before", F.coalesce(F.sum(fresh).over(earlier), F.lit(0)))


def placed_blocks(blocks: DataFrame, files: DataFrame, first_offset: int = 0) -> DataFrame:
    """Closed blocks that have not been taken yet, with their `offset`: they follow each other from `first_offset`,
    file by file, and are the same whenever they are read, without sorting the blocks."""
    places = files.select("file", "modified", "taken", "before")
    offset = F.lit(first_offset) + F.col("before") + F.col("block_no") - F.col("taken")
    fresh = blocks.join(places, "file").where("block_no >= taken")
    return fresh.withColumn("offset", offset.cast("bigint")).drop("taken", "before")


def new_positions(files: DataFrame, number: int, last: tuple | None = None) -> DataFrame:
    """What has been taken of each file after this batch; `last`: (modified, file, block_no) of the last event taken,
    where the batch stops there. Files behind it stay as they are."""
    blocks, whole = F.col("blanks"), F.lit(True)
    if last is not None:
        modified, file, block_no = last
        place = F.struct(F.col("modified"), F.col("file"))
        end = F.struct(F.lit(modified), F.lit(file))
        files = files.where(place <= end)
        blocks = F.when(place == end, F.lit(block_no) + 1).otherwise(blocks)
        whole = (place < end) | (blocks == F.col("blanks"))
    return files.select("file", "size", "modified", blocks.cast("bigint").alias("blocks"), whole.alias("whole"), F.lit(number).cast("bigint").alias("number"))


def store_raw(
    events: DataFrame, write: Callable[[DataFrame], None], wikis: Collection[str] = ()
) -> dict[str, int]:
    """Hand the raw records of events to `write`; received, produced, skipped and bytes_in are
    counted on the way."""
    counters = Observation()
    counted = routing.with_route(events, wikis).observe(counters, *routing.counters())
    write(counted.where("accepted").select("key", F.col("data").alias("value"), "offset"))
    return counters.get


def to_table(path: str) -> Callable[[DataFrame], None]:
    """Into a folder of its own; what an attempt that failed has left there is replaced."""
    return lambda records: records.write.mode("overwrite").parquet(path)


def to_topic(settings: Settings) -> Callable[[DataFrame], None]:
    return lambda records: kafka.write_records(kafka.in_key_order(records), settings, "raw")
