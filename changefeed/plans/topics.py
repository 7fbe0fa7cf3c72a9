"""The three jobs from topic to topic: records in, records out, bounded or as streams.

Input records have `key`, `value` and `offset`, as read from Kafka or from a table of records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from changefeed.operators import clean as C
from changefeed.operators import keyed, stats
from changefeed.operators.wars import edit_wars
from changefeed.session import scratch_table
from changefeed.settings import Settings
from changefeed.streaming.wars import edit_wars_stream


def clean_records(raw: DataFrame, settings: Settings, lossless: bool = False) -> DataFrame:
    """Raw records to clean and dead-letter records, each with its `topic`."""
    split = C.split_raw(raw.select("value", "offset"), lossless)
    return keyed.encode_split(split, settings.topic("clean"), settings.topic("dlq"))


def stats_records(clean: DataFrame, settings: Settings) -> DataFrame:
    """Clean records to upserts of window statistics."""
    edits = keyed.decode_keyed(clean)
    return keyed.encode_upsert(stats.wiki_stats(edits, settings.window_minutes, settings.out_of_order_seconds))


def war_records(clean: DataFrame, settings: Settings) -> DataFrame:
    """Clean records to alerts. A bounded topic is read once, to a stored table: the batch rule reads its edits
    several times, and each read of a topic may end elsewhere."""
    edits = keyed.decode_keyed(clean)
    if edits.isStreaming:
        return keyed.encode_append(edit_wars_stream(edits, settings.war_seconds, settings.out_of_order_seconds))
    path = scratch_table(clean.sparkSession, "decoded")
    edits.write.parquet(path)
    stored = clean.sparkSession.read.schema(edits.schema).parquet(path)
    return keyed.encode_append(edit_wars(stored, settings.war_seconds))
