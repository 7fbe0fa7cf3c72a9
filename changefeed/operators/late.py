"""Edits that arrive after their window has closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefeed.settings import check_positive


def late_edits(
    clean: DataFrame,
    window_minutes: int = 1,
    delay_seconds: int = 15,
    partition: str = "partition",
    offset: str = "offset",
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Edits whose window ended at or before the watermark of their source partition.

    The watermark before an edit is the greatest event time among earlier offsets, less the
    delay. The running maximum is taken over blocks of offsets and then inside each block,
    so a partition holding most of the feed is still shared among many tasks.
    """
    check_positive("window_minutes", window_minutes)
    check_positive("delay_seconds", delay_seconds)
    blocked = clean.where(F.col("event_time").isNotNull()).withColumn(
        "block", F.floor(F.col(offset) / F.lit(check_positive("block_rows", block_rows)))
    )
    earlier_blocks = Window.partitionBy(partition).orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    block_maxima = (
        blocked.groupBy(partition, "block")
        .agg(F.max("event_time").alias("block_max"))
        .select(partition, "block", F.max("block_max").over(earlier_blocks).alias("max_before_block"))
    )
    earlier_rows = (
        Window.partitionBy(partition, "block").orderBy(offset).rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = F.greatest(F.max("event_time").over(earlier_rows), F.col("max_before_block"))
    return (
        blocked.join(block_maxima, [partition, "block"])
        .withColumn("watermark", seen - F.make_dt_interval(secs=F.lit(delay_seconds)))
        .withColumn("window_end", F.window("event_time", f"{window_minutes} minutes").end)
        .where(F.col("window_end") <= F.col("watermark"))
        .drop("block", "max_before_block")
    )
