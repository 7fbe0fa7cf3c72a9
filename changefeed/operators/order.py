"""Order per key as a checked result, without one task per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefeed.session import checkpointed


def sequenced(records: DataFrame, key: str = "key", order: str = "offset", parts: int | None = None) -> DataFrame:
    """The records with `seq`, their number 0, 1, 2, ... within their key by `order`, and `part`.

    Rows are dealt by ranges of (key, order), so a key with a third of all rows fills several parts,
    one after the other, and each part is in order. They are stored once; numbers inside a part are
    then shifted by the rows of the key in earlier parts, one small row per part and key in it. Whoever
    reads the rows, of a part or of a topic they were written to, can tell by `seq` whether any is missing,
    twice or out of place. A null key is a key. `order` must tell the rows of a key apart.

    parts: how many to deal, by default as many as a shuffle of the session has.
    """
    by = (key, order)
    ranged = records.repartitionByRange(parts, *by) if parts else records.repartitionByRange(*by)
    placed = ranged.sortWithinPartitions(*by).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("_place")
    )
    placed = checkpointed(placed)
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(key, "part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    shifts = checkpointed(counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))))
    shifts = shifts.select(F.col(key).alias("_key"), F.col("part").alias("_part"), "_first", "_before")
    same = placed[key].eqNullSafe(shifts["_key"]) & (placed["part"] == shifts["_part"])
    seq = F.col("_before") + F.col("_place") - F.col("_first")
    return placed.join(shifts, same).select(*records.columns, seq.alias("seq"), "part")


def out_of_order(sequence: DataFrame, key: str = "key", order: str = "offset") -> DataFrame:
    """(key, missing, repeated, misplaced) of the keys whose records do not follow each other: numbers left out,
    numbers that come twice, and rows with a smaller `order` than the number before. No rows if all is well."""
    counted = sequence.groupBy(key, "seq").agg(F.count("*").alias("n"), F.min(order).alias("low"), F.max(order).alias("high"))
    # a pair of neighbours is two rows of one group, so no key is sorted or gathered
    pairs = counted.select(key, F.col("seq").alias("at"), "low", F.lit(None).cast("bigint").alias("high")).unionByName(
        counted.select(key, (F.col("seq") + 1).alias("at"), F.lit(None).cast("bigint").alias("low"), "high")
    )
    wrong = pairs.groupBy(key, "at").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <= high")
    misplaced = wrong.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("misplaced"))
    totals = counted.groupBy(key).agg(
        (F.max("seq") + 1 - F.count("*")).alias("missing"), F.sum(F.col("n") - 1).alias("repeated")
    )
    joined = totals.join(misplaced, totals[key].eqNullSafe(misplaced["_key"]), "left")
    found = joined.select(key, "missing", "repeated", F.coalesce("misplaced", F.lit(0)).alias("misplaced"))
    return found.where("missing > 0 or repeated > 0 or misplaced > 0")
