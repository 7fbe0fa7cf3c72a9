"""Record tables on shared storage, bounded or as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changefeed import schemas

RAW_RECORD = "key STRING, value STRING, offset BIGINT"
SPLIT_EDIT = f"{schemas.CLEAN_EDIT}, reject_reason STRING, raw_timestamp BIGINT, rejected_at TIMESTAMP, offset BIGINT, outlet STRING"


BYTES_PER_TRIGGER = 1 << 30


def read_table(
    spark: SparkSession, path: str, schema: str, stream: bool = False, per_trigger: int = BYTES_PER_TRIGGER
) -> DataFrame:
    """Rows of a Parquet table. A folder written by a stream is read through its commit log, so
    only committed files are seen; a stream starts with the earliest files and takes at most
    `per_trigger` bytes of them, one file at least, at a time."""
    reader = (spark.readStream if stream else spark.read).schema(schema)
    if stream:
        reader = reader.option("maxBytesPerTrigger", per_trigger)
    return reader.parquet(path)


def raw_records(spark: SparkSession, path: str, stream: bool = False, per_trigger: int = BYTES_PER_TRIGGER) -> DataFrame:
    return read_table(spark, path, RAW_RECORD, stream, per_trigger).select("key", "value", "offset")


def split_edits_table(
    spark: SparkSession, path: str, stream: bool = False, per_trigger: int = BYTES_PER_TRIGGER
) -> DataFrame:
    """Both outlets of the clean job; a filter on `outlet` reads only that outlet's files."""
    return read_table(spark, path, SPLIT_EDIT, stream, per_trigger)
