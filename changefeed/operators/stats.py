"""Per-wiki activity in tumbling event-time windows, with exact distinct counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed import schemas
from changefeed.functions import edits as E
from changefeed.settings import check_positive

SKETCH_LG_K = 12
MEASURES = ("edits", "bot_edits", "human_edits", "new_pages", "bytes_added", "bytes_removed", "net_bytes")


def _one_if(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _measures() -> dict[str, Column]:
    """What one edit adds to each sum of its window."""
    delta = F.coalesce("byte_delta", F.lit(0)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return {
        "edits": F.lit(1).cast("bigint"),
        "bot_edits": _one_if(F.col("is_bot")),
        "human_edits": _one_if(~F.col("is_bot")),
        "new_pages": _one_if(F.col("type") == "new"),
        "bytes_added": F.greatest(delta, zero),
        "bytes_removed": F.least(delta, zero),
        "net_bytes": delta,
    }


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _tumbling(window_minutes: int) -> Column:
    return F.window("event_time", f"{check_positive('window_minutes', window_minutes)} minutes")


def window_parts(clean: DataFrame, window_minutes: int = 1, delay_seconds: int = 15) -> DataFrame:
    """Totals per (window, wiki, editor) and one marker per (window, wiki, page).

    The window of a busy wiki is spread over its editors and pages, each row being combined
    before the shuffle, so no task ever holds the set of editors of a whole wiki.
    """
    check_positive("delay_seconds", delay_seconds)
    of_editor = F.col("kind") == "user"
    member = F.when(of_editor, F.col("user")).otherwise(F.col("title"))
    measures = {
        name: F.when(of_editor, amount).otherwise(F.lit(0).cast("bigint"))
        for name, amount in _measures().items()
    }
    return (
        clean.withWatermark("event_time", f"{delay_seconds} seconds")
        .withColumn("kind", F.explode(F.array(F.lit("user"), F.lit("title"))))
        .select("event_time", "wiki", "kind", member.alias("member"), *_aliased(measures))
        .groupBy(_tumbling(window_minutes), "wiki", "kind", "member")
        .agg(*[F.sum(name).alias(name) for name in MEASURES])
    )


def roll_up(parts: DataFrame) -> DataFrame:
    """The statistics row of each (window, wiki) from its parts."""
    def members(kind: str) -> Column:
        return F.count_if((F.col("kind") == kind) & F.col("member").isNotNull())

    totals = parts.groupBy("window", "wiki").agg(
        *[F.sum(name).alias(name) for name in MEASURES],
        members("user").alias("editors"),
        members("title").alias("pages_touched"),
    )
    return _final_columns(totals)


def _final_columns(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "*",
        E.bot_share(F.col("bot_edits"), F.col("edits")).alias("bot_share_pct"),
    ).select(*schemas.names(schemas.WIKI_STATS))


def wiki_stats(
    clean: DataFrame, window_minutes: int = 1, delay_seconds: int = 15, approx: bool = False
) -> DataFrame:
    """Counts, distinct editors and pages, byte sums and bot share per (window, wiki).

    On a stream this is an append-mode query: a window appears once, when the watermark
    passes its end. `approx` swaps the exact distinct counts for sketches of fixed size,
    which keeps a single aggregation and so also allows update mode.
    """
    if not approx:
        return roll_up(window_parts(clean, window_minutes, delay_seconds))
    check_positive("delay_seconds", delay_seconds)
    totals = (
        clean.withWatermark("event_time", f"{delay_seconds} seconds")
        .groupBy(_tumbling(window_minutes), "wiki")
        .agg(
            *_aliased({name: F.sum(amount) for name, amount in _measures().items()}),
            F.approx_count_distinct("user", 0.01).alias("editors"),
            F.approx_count_distinct("title", 0.01).alias("pages_touched"),
        )
    )
    return _final_columns(totals)


def sketched_stats(clean: DataFrame, window_minutes: int = 1, delay_seconds: int = 15, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Sums per (window, wiki) with a mergeable sketch of its editors and one of its pages, to be stored.

    One aggregation, combined before the shuffle; a row takes at most some 2^lg_k bytes per sketch,
    and a few for few members. On a stream it works in append and in update mode.
    """
    check_positive("delay_seconds", delay_seconds)
    totals = (
        clean.withWatermark("event_time", f"{delay_seconds} seconds")
        .groupBy(_tumbling(window_minutes), "wiki")
        .agg(
            *_aliased({name: F.sum(amount) for name, amount in _measures().items()}),
            F.hll_sketch_agg("user", lg_k).alias("editors_sketch"),
            F.hll_sketch_agg("title", lg_k).alias("pages_sketch"),
        )
    )
    return totals.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "wiki", *MEASURES, "editors_sketch", "pages_sketch"
    )


def widen(sketched: DataFrame, window_minutes: int) -> DataFrame:
    """`sketched_stats` in wider windows, from narrower ones alone: sums are added, sketches united.

    The wider window must be a multiple of the narrower one.
    """
    return (
        sketched.groupBy(F.window("window_start", f"{check_positive('window_minutes', window_minutes)} minutes"), "wiki")
        .agg(
            *[F.sum(name).alias(name) for name in MEASURES],
            F.hll_union_agg("editors_sketch").alias("editors_sketch"),
            F.hll_union_agg("pages_sketch").alias("pages_sketch"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*")
        .drop("window")
    )


def estimated(sketched: DataFrame) -> DataFrame:
    """The statistics rows of sketched ones. Counts of members are exact for some hundreds; of more, the standard
    error is 1.04 / sqrt(2^lg_k), 1.6 % at the default, and three times that is hardly ever passed."""
    counted = sketched.select(
        F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"),
        "wiki",
        *MEASURES,
        F.hll_sketch_estimate("editors_sketch").alias("editors"),
        F.hll_sketch_estimate("pages_sketch").alias("pages_touched"),
    )
    return _final_columns(counted)
