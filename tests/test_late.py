import random

import pytest
from pyspark.sql import functions as F

from changefeed.operators.late import late_edits

T0 = 1700000040


@pytest.mark.parametrize("block_rows", [1, 7, 1000])
def test_against_plain_python(spark, block_rows):
    rnd = random.Random(block_rows)
    rows = [
        (0 if rnd.random() < 0.7 else 1, i, T0 + i * 2 - rnd.choice([0, 0, 0, 70, 200])) for i in range(600)
    ]
    want, newest = set(), {}
    for partition, offset, second in rows:
        window_end = second // 60 * 60 + 60
        if partition in newest and window_end <= newest[partition] - 15:
            want.add((partition, offset, window_end, newest[partition] - 15))
        newest[partition] = max(second, newest.get(partition, second))
    df = spark.createDataFrame(rows, "partition int, offset bigint, second bigint").withColumn(
        "event_time", F.timestamp_seconds("second")
    )
    got = late_edits(df, block_rows=block_rows).select(
        "partition", "offset", F.unix_seconds("window_end"), F.unix_seconds("watermark")
    )
    assert {tuple(row) for row in got.collect()} == want
    assert want


def test_nothing_late_in_order(spark):
    df = spark.range(500).selectExpr("0 as partition", "id as offset", "timestamp_seconds(id * 30) as event_time")
    assert late_edits(df, block_rows=50).count() == 0
