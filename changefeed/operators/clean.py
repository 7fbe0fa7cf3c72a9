"""Raw change events to validated edits and a dead-letter table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed import schemas
from changefeed.functions import edits as E

CLEAN = "clean"
DEAD_LETTER = "dlq"


def parse_raw(raw: DataFrame, value: str = "value", schema: str = schemas.RAW_EDIT) -> DataFrame:
    """Decode JSON text leniently and add `event_time`.

    A field of the wrong type becomes null and the rest is kept; text that is no JSON gives a
    row of nulls. Other columns of `raw` (such as `offset`) pass through. The text is decoded
    by a generator, which later filters cannot be pushed through: each text is parsed once.
    """
    kept = [name for name in raw.columns if name != value]
    decoded = F.from_json(value, schema, {"mode": "PERMISSIVE", **schemas.JSON_LIMITS})
    return raw.select(*kept, F.inline(F.array(decoded))).withColumn(
        "event_time", E.event_time(F.col("timestamp"))
    )


def split_edits(parsed: DataFrame, lossless: bool = False) -> DataFrame:
    """Mark each parsed edit with its `outlet`, so one pass over the source feeds both outputs.

    The result holds the columns of clean edits and of rejected ones side by side (plus
    `offset` if given). Written with `partitionBy("outlet")`, both outputs are committed by
    the same job and cannot disagree about a record. An edit whose type is null reaches
    neither outlet unless `lossless`; one whose time no calendar holds is clean without an
    `event_time`, and `lossless` rejects it.
    """
    col = F.col
    reason = E.reject_reason(
        col("wiki"), col("title"), col("user"), col("timestamp"), col("type"), lossless
    )
    outlet = F.when(col("reject_reason").isNotNull(), DEAD_LETTER).when(
        col("type").isNotNull(), CLEAN
    )
    marked = parsed.withColumn("reject_reason", reason).withColumn("outlet", outlet)
    return marked.where(col("outlet").isNotNull()).select(
        "outlet",
        "wiki",
        "server_name",
        col("meta.domain").alias("domain"),
        "type",
        "namespace",
        "title",
        "user",
        F.coalesce("bot", F.lit(False)).alias("is_bot"),
        F.coalesce("minor", F.lit(False)).alias("is_minor"),
        E.byte_delta(col("length.old"), col("length.new")).alias("byte_delta"),
        col("length.new").alias("new_length"),
        "comment",
        col("revision.new").alias("revision_id"),
        "event_time",
        "reject_reason",
        col("timestamp").alias("raw_timestamp"),
        F.current_timestamp().alias("rejected_at"),
        *[name for name in ("offset",) if name in parsed.columns],
    )


def clean_of(split: DataFrame) -> DataFrame:
    extra = [name for name in ("offset",) if name in split.columns]
    return split.where(F.col("outlet") == CLEAN).select(*schemas.names(schemas.CLEAN_EDIT), *extra)


def dead_letters_of(split: DataFrame) -> DataFrame:
    return split.where(F.col("outlet") == DEAD_LETTER).select(*schemas.names(schemas.REJECTED_EDIT))


def split_raw(raw: DataFrame, lossless: bool = False) -> DataFrame:
    """Raw records to split edits, decoding only the fields these need."""
    return split_edits(parse_raw(raw, schema=schemas.RAW_NEEDED), lossless)


def clean_edits(raw: DataFrame) -> DataFrame:
    return clean_of(split_raw(raw))


def dlq_edits(raw: DataFrame, lossless: bool = False) -> DataFrame:
    return dead_letters_of(split_raw(raw, lossless))
