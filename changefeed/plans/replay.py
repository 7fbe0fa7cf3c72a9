"""Bounded replay: the three jobs one after another over what is stored, as batch runs.

A batch run sees the end of its input, so every window closes. Each table is overwritten, so a
replay can be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changefeed.operators import clean as C
from changefeed.operators import stats
from changefeed.operators.keyed import topic_counts
from changefeed.operators.wars import edit_wars
from changefeed.settings import Settings
from changefeed.sources import files


def replay(raw: DataFrame, root: str, settings: Settings = Settings(), lossless: bool = False) -> None:
    """Write tables `edits` (both outlets in one pass), `stats` and `wars` under `root`."""
    replay_clean(raw, root, lossless)
    edits = clean_table(raw.sparkSession, root)
    stats.wiki_stats(edits, settings.window_minutes, settings.out_of_order_seconds).write.mode(
        "overwrite"
    ).parquet(f"{root}/stats")
    edit_wars(edits, settings.war_seconds).write.mode("overwrite").parquet(f"{root}/wars")


def replay_clean(raw: DataFrame, root: str, lossless: bool = False) -> None:
    split = C.split_raw(raw, lossless).drop("key")
    split.write.mode("overwrite").partitionBy("outlet").parquet(f"{root}/edits")


def clean_table(spark: SparkSession, root: str) -> DataFrame:
    return C.clean_of(files.split_edits_table(spark, f"{root}/edits"))


def dead_letter_table(spark: SparkSession, root: str) -> DataFrame:
    return C.dead_letters_of(files.split_edits_table(spark, f"{root}/edits"))


def counts(spark: SparkSession, raw: DataFrame, root: str, settings: Settings = Settings()) -> DataFrame:
    """Records per topic after a replay."""
    return topic_counts(
        {
            settings.topic("raw"): raw,
            settings.topic("clean"): clean_table(spark, root),
            settings.topic("dlq"): dead_letter_table(spark, root),
            settings.topic("stats"): spark.read.parquet(f"{root}/stats"),
            settings.topic("alerts"): spark.read.parquet(f"{root}/wars"),
        }
    )
