"""The `events` table read as a feed of page edits, broken records included.

Every event becomes one edit. Fixed remainders of the event id decide which field is missing,
so each rule of the clean job is hit; the same rules are written in SQL in `oracle.py`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Start of the test data, and how many times faster the dense feed's clock runs.
FIRST_SECOND = 1704067200
CLOCK_DIVISOR = 60


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn(
        "seconds", F.unix_seconds(F.col("ts").cast("timestamp"))
    )


def _unless_every(n: int, value: Column) -> Column:
    return F.when(F.col("event_id") % n != 0, value)


def raw_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records: `value` is the JSON payload, `offset` the order of arrival."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    rest = event_id % 11
    kind = (
        F.when(event_id % 44 == 4, None)
        .when(rest == 0, "new")
        .when(rest == 1, "categorize")
        .when(rest == 2, "log")
        .when(rest == 3, "bogus")
        .otherwise("edit")
    )
    site = F.concat("event_type", F.lit(".example.org"))
    payload = F.struct(
        F.struct(site.alias("domain")).alias("meta"),
        event_id.alias("id"),
        kind.alias("type"),
        F.lit(0).alias("namespace"),
        _unless_every(89, F.concat(F.lit("page_"), event_id % 20)).alias("title"),
        F.col("props").alias("comment"),
        _unless_every(79, F.col("seconds")).alias("timestamp"),
        _unless_every(83, F.concat(F.lit("u"), user_id % 4)).alias("user"),
        _unless_every(13, user_id % 11 == 0).alias("bot"),
        (event_id % 5 == 0).alias("minor"),
        F.struct(
            _unless_every(11, (user_id * 10).cast("int")).alias("old"),
            (user_id * 10 + F.floor("value") - 20).cast("int").alias("new"),
        ).alias("length"),
        F.struct(event_id.alias("new")).alias("revision"),
        site.alias("server_name"),
        _unless_every(97, F.col("event_type")).alias("wiki"),
    )
    value = _unless_every(101, F.to_json(payload, {"ignoreNullFields": "false"}))
    return events(spark, sf_dir).select(
        event_id.alias("offset"), F.coalesce(value, F.lit("not json")).alias("value")
    )


def dense_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean edits, one per event, on a clock fast enough for ten-minute sequences."""
    second = F.floor((F.col("seconds") - FIRST_SECOND) / CLOCK_DIVISOR) + FIRST_SECOND
    return events(spark, sf_dir).select(
        F.col("event_type").alias("wiki"),
        F.concat(F.lit("page_"), F.col("event_id") % 20).alias("title"),
        F.concat(F.lit("u"), F.col("user_id") % 4).alias("user"),
        (F.col("user_id") % 11 == 0).alias("is_bot"),
        (F.floor("value") - 20).cast("int").alias("byte_delta"),
        F.timestamp_seconds(second).alias("event_time"),
        F.col("event_id").alias("offset"),
    )


def shuffled_arrivals(clean: DataFrame) -> DataFrame:
    """Clean edits as three source partitions, every seventh edit arriving 40 places late."""
    delayed = F.when(F.col("offset") % 7 == 0, F.col("offset") + 40).otherwise(F.col("offset"))
    return clean.select(
        "wiki",
        "title",
        "user",
        "event_time",
        "revision_id",
        (F.col("revision_id") % 3).alias("partition"),
        (delayed * 2 + F.when(F.col("offset") % 7 == 0, 1).otherwise(0)).alias("offset"),
    )


def capture_lines(raw: DataFrame) -> DataFrame:
    """The feed as server-sent-event text, one block per row, with every quirk of the format.

    Some blocks have two data lines, some end their lines with CRLF, and some carry comments,
    unknown names, retry hints, or an id without data. The writer adds the last newline.
    """
    n = F.col("offset")
    newline = F.when(n % 6 == 0, "\r\n").otherwise("\n")

    def line(*parts: Column | str, when: Column) -> Column:
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], newline)
        return F.when(when, text).otherwise("")

    return raw.orderBy("offset").select(
        F.concat(
            line(":ok", when=n % 5 == 0),
            line("id: ", n.cast("string"), when=n % 4 != 3),
            line("event:edit", when=n % 9 == 0),
            line("weird: thing", when=n % 10 == 0),
            line("retry: ", F.when(n % 24 == 0, "soon").otherwise((n % 100).cast("string")), when=n % 12 == 0),
            line("data: first", when=n % 8 == 0),
            line("data:", F.col("value"), when=n % 17 != 0),
            F.when(n % 6 == 0, "\r").otherwise(""),
        ).alias("value")
    )
