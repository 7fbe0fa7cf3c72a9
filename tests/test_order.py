"""Numbers within a key, whatever the tasks."""

import random

import pytest
from pyspark.sql import functions as F

from changefeed.operators.order import out_of_order, sequenced

RECORD = "key string, offset bigint, value string"


@pytest.fixture
def records(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["busy", "busy", "a", "b", "c", None]), offset, f"v{offset}") for offset in rng.sample(range(10**6), 6000)]
    return rows, spark.createDataFrame(rows, RECORD).repartition(5)


def test_sequence_equals_sorting(records):
    rows, df = records
    expected = {}
    for key in {key for key, _, _ in rows}:
        for seq, offset in enumerate(sorted(o for k, o, _ in rows if k == key)):
            expected[key, offset] = seq
    got = sequenced(df, parts=12).collect()
    assert {(r.key, r.offset): r.seq for r in got} == expected and len(got) == len(rows)


def test_a_busy_key_fills_several_parts(records):
    rows, df = records
    parts = sequenced(df, parts=12).groupBy("key").agg(F.count_distinct("part").alias("parts"), F.count("*").alias("n"))
    busy = {r.key: (r.parts, r.n) for r in parts.collect()}["busy"]
    assert busy[1] > len(rows) / 4 and busy[0] >= 3
    sizes = [r["count"] for r in sequenced(df, parts=12).groupBy("part").count().collect()]
    assert max(sizes) < 3 * len(rows) / 12


def test_parts_are_in_order(records):
    _, df = records
    for part in range(3):
        rows = sequenced(df, parts=12).where(F.col("part") == part).collect()
        assert [(r.key or "", r.seq) for r in rows] == sorted((r.key or "", r.seq) for r in rows)


def test_what_a_reader_finds(spark, records):
    _, df = records
    good = sequenced(df, parts=4).drop("part", "value")
    assert out_of_order(good).collect() == []
    lost = good.where("not (key <=> 'a' and seq = 7)")
    assert [tuple(r) for r in out_of_order(lost).collect()] == [("a", 1, 0, 0)]
    twice = good.unionByName(good.where("key is null and seq in (3, 5)"))
    assert [tuple(r) for r in out_of_order(twice).collect()] == [(None, 0, 2, 0)]
    swapped = good.withColumn("seq", F.when((F.col("key") == "b") & F.col("seq").isin(4, 5), 9 - F.col("seq")).otherwise(F.col("seq")))
    assert [tuple(r) for r in out_of_order(swapped).collect()] == [("b", 0, 0, 1)]
    assert out_of_order(good.limit(0)).collect() == [] and sequenced(df.limit(0)).collect() == []
