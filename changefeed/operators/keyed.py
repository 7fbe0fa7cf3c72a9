"""Keyed records: a key column, a JSON value column, and views over them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed import schemas
from changefeed.functions import edits as E
from changefeed.operators.clean import CLEAN

KEEP_NULLS = {"ignoreNullFields": "false"}


def _json(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns), KEEP_NULLS)


def _wire(ddl: str) -> list[Column]:
    """The declared columns as they go on the wire."""
    return [
        E.wire_timestamp(F.col(name)).alias(name) if kind == "TIMESTAMP" else F.col(name)
        for name, kind in schemas.fields(ddl)
    ]


def encode_keyed(clean: DataFrame) -> DataFrame:
    """Key is the wiki; the value is every other column as JSON, so the key is not in it."""
    kept = [name for name in ("offset",) if name in clean.columns]
    return clean.select(F.col("wiki").alias("key"), _clean_value().alias("value"), *kept)


def _clean_value() -> Column:
    return _json(*_wire(schemas.without(schemas.CLEAN_EDIT, "wiki")))


def encode_split(split: DataFrame, clean_topic: str, dead_letter_topic: str) -> DataFrame:
    """Both outlets of split edits as records with their topic, so one read feeds two topics."""
    is_clean = F.col("outlet") == CLEAN
    return split.select(
        F.when(is_clean, F.lit(clean_topic)).otherwise(F.lit(dead_letter_topic)).alias("topic"),
        F.when(is_clean, F.col("wiki")).alias("key"),
        F.when(is_clean, _clean_value()).otherwise(_json(*_wire(schemas.REJECTED_EDIT))).alias("value"),
        *[name for name in ("offset",) if name in split.columns],
    )


def decode_keyed(records: DataFrame) -> DataFrame:
    """Back to clean edits: the wiki is read from the key, and a damaged value fails the job."""
    wire_schema = schemas.without(schemas.CLEAN_EDIT, "wiki", "event_time") + ", event_time STRING"
    decoded = F.from_json(F.col("value").cast("string"), wire_schema, {"mode": "FAILFAST", **schemas.JSON_LIMITS})
    kept = [name for name in ("offset",) if name in records.columns]
    # Decoded by a generator, so that no later filter makes the text be parsed again.
    return (
        records.select(F.col("key").cast("string").alias("wiki"), F.inline(F.array(decoded)), *kept)
        .withColumn("event_time", F.col("event_time").cast("timestamp"))
        .select(*schemas.names(schemas.CLEAN_EDIT), *kept)
    )


def encode_append(rows: DataFrame) -> DataFrame:
    """Unkeyed JSON records, as used for dead letters and alerts."""
    columns = _wire("\n".join(f"{name} {kind.upper()}" for name, kind in rows.dtypes))
    return rows.select(F.lit(None).cast("string").alias("key"), _json(*columns).alias("value"))


def encode_upsert(stats: DataFrame) -> DataFrame:
    """Key is JSON of (window_start, wiki); the value is JSON of the whole row.

    Window bounds are UTC and carry no zone on the wire.
    """
    columns = {
        name: E.utc_text(F.col(name)).alias(name) if kind == "timestamp" else F.col(name)
        for name, kind in stats.dtypes
    }
    return stats.select(
        _json(columns["window_start"], columns["wiki"]).alias("key"),
        _json(*columns.values()).alias("value"),
        *[name for name in ("offset",) if name in stats.columns],
    )


def latest_per_key(records: DataFrame, keys: tuple[str, ...] = ("key",), order: str = "offset") -> DataFrame:
    """What a compacted topic keeps: the row with the greatest `order` for each key.

    `order` must tell a key's rows apart, as offsets do. Only keys and orders are combined, in
    hash aggregates before and after the shuffle; the rows themselves are then looked up.
    """
    newest = records.groupBy(*keys).agg(F.max(order).alias("_newest"))
    newest = newest.select(*[F.col(name).alias(f"_{name}") for name in keys], "_newest")
    same = [records[name].eqNullSafe(newest[f"_{name}"]) for name in keys]
    return records.join(newest, [*same, records[order].eqNullSafe(newest["_newest"])], "left_semi")


def topic_counts(topics: Mapping[str, DataFrame]) -> DataFrame:
    """Number of records in each topic."""
    counts = [
        rows.agg(F.count("*").alias("records")).select(F.lit(name).alias("topic"), "records")
        for name, rows in topics.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def tail(records: DataFrame, n: int, order: str = "offset") -> DataFrame:
    """The first `n` records of a topic."""
    return records.orderBy(order).limit(n)
