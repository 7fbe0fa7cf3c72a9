"""Kafka topics behind the same functions. The connector package comes with spark-submit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from changefeed.settings import Settings

# Producer settings of the feed.
PRODUCER = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.compression.type": "zstd",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "65536",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.retries": "2147483647",
    "kafka.delivery.timeout.ms": "120000",
}


def source_options(settings: Settings, stage: str, group: str | None = None) -> dict[str, str]:
    """Earliest offset on, committed records only; bounded reads stop at the present end, streams
    take a bounded number of records at a time."""
    options = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic(stage),
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
    }
    if group:
        options["kafka.group.id"] = group
    if settings.bounded:
        options["endingOffsets"] = "latest"
    else:
        options["maxOffsetsPerTrigger"] = str(settings.offsets_per_trigger)
    return options


def sink_options(settings: Settings, stage: str | None = None) -> dict[str, str]:
    """Without a stage, each record goes to the topic in its `topic` column."""
    options = {"kafka.bootstrap.servers": settings.bootstrap_servers, **PRODUCER}
    return {**options, "topic": settings.topic(stage)} if stage else options


def read_topic(spark: SparkSession, settings: Settings, stage: str, **options) -> DataFrame:
    reader = spark.read if settings.bounded else spark.readStream
    records = reader.format("kafka").options(**source_options(settings, stage, **options)).load()
    return records.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "partition", "offset"
    )


def write_records(records: DataFrame, settings: Settings, stage: str | None = None) -> None:
    """Bounded write; delivery is at least once."""
    _record_columns(records).write.format("kafka").options(**sink_options(settings, stage)).save()


def in_key_order(records: DataFrame) -> DataFrame:
    """Records of a key in one task and in order of offset, so that they stay in order on their
    topic partition, which takes them one after another anyway.

    For batches of bounded size, such as one trigger's files. Records read from a topic keyed
    alike need no such step.
    """
    return records.repartition("key").sortWithinPartitions("key", "offset")


def stream_records(
    records: DataFrame, settings: Settings, stage: str | None = None, mode: str = "append"
) -> DataStreamWriter:
    """Unstarted writer; delivery is at least once, so readers needing more use the table sink."""
    writer = _record_columns(records).writeStream.format("kafka")
    return writer.options(**sink_options(settings, stage)).outputMode(mode)


def _record_columns(records: DataFrame) -> DataFrame:
    return records.select(*[name for name in ("topic", "key", "value") if name in records.columns])
