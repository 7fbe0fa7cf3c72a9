import json

import pytest
from pyspark.sql import functions as F

from changefeed import schemas
from changefeed.functions import edits as E
from changefeed.operators import clean as C
from changefeed.operators import keyed, stats
from tests.test_clean import record


@pytest.fixture
def clean(spark):
    values = [
        record(),
        record(wiki="dewiki", title='a "b" \\ ü 漢', comment=None),
        record(length=..., meta=..., timestamp=1700000007),
    ]
    raw = spark.createDataFrame(list(enumerate(values)), "offset bigint, value string")
    return C.clean_edits(raw)


def test_key_is_not_in_the_value(clean):
    rows = keyed.encode_keyed(clean).orderBy("offset").collect()
    value = json.loads(rows[0]["value"])
    assert rows[0]["key"] == "enwiki"
    assert list(value) == [n for n in schemas.names(schemas.CLEAN_EDIT) if n != "wiki"]
    assert value["event_time"] == "2023-11-14 22:13:20Z"


def test_records_do_not_depend_on_the_session_zone(spark, clean):
    def records():
        dead = C.dlq_edits(spark.createDataFrame([(0, record(user=...))], "offset bigint, value string")).drop("rejected_at")
        wire = [keyed.encode_keyed(clean), keyed.encode_upsert(stats.wiki_stats(clean)), keyed.encode_append(dead)]
        instants = keyed.decode_keyed(wire[0]).select(F.unix_micros("event_time"))
        return [sorted(map(str, rows.collect())) for rows in (*wire, instants)]

    utc = records()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert records() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_wire_timestamps_keep_fractions(spark):
    rows = spark.sql("select timestamp '2024-01-01 00:00:07.25Z' t union all select timestamp '1965-03-04 05:06:07Z'")
    assert sorted(r[0] for r in rows.select(E.wire_timestamp(F.col("t"))).collect()) == ["1965-03-04 05:06:07Z", "2024-01-01 00:00:07.25Z"]


def test_nulls_are_written(clean):
    rows = keyed.encode_keyed(clean).orderBy("offset").collect()
    value = json.loads(rows[2]["value"])
    assert value["domain"] is None and value["new_length"] is None


def test_round_trip(clean):
    back = keyed.decode_keyed(keyed.encode_keyed(clean))
    assert back.columns == clean.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, clean.collect()))
    assert back.agg(F.count("wiki")).first()[0] == 3


def test_binary_records_are_decoded(clean):
    records = keyed.encode_keyed(clean).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "offset"
    )
    assert sorted(map(str, keyed.decode_keyed(records).collect())) == sorted(map(str, clean.collect()))


@pytest.mark.parametrize("value", ["not json", '{"byte_delta": "oops"}'])
def test_damaged_value_fails_the_job(spark, value):
    records = spark.createDataFrame([("enwiki", value)], "key string, value string")
    with pytest.raises(Exception, match="(?i)malformed"):
        keyed.decode_keyed(records).collect()


def test_upsert_records(clean):
    rows = {r["key"]: json.loads(r["value"]) for r in keyed.encode_upsert(stats.wiki_stats(clean)).collect()}
    key = '{"window_start":"2023-11-14 22:13:00","wiki":"enwiki"}'
    assert rows[key]["window_end"] == "2023-11-14 22:14:00"
    assert rows[key]["edits"] == 2 and rows[key]["bot_share_pct"] == 0.0
    assert list(rows[key]) == schemas.names(schemas.WIKI_STATS)


def test_append_records(spark):
    raw = spark.createDataFrame([(0, record(user=...))], "offset bigint, value string")
    row = keyed.encode_append(C.dlq_edits(raw)).first()
    value = json.loads(row["value"])
    assert row["key"] is None
    assert value["reject_reason"] == "missing_user" and value["user"] is None
    assert value["raw_timestamp"] == 1700000000
    assert value["rejected_at"].endswith("Z")


def test_both_outlets_as_records(spark):
    raw = spark.createDataFrame([(0, record()), (1, record(user=...))], "offset bigint, value string")
    split = C.split_raw(raw)
    rows = {row["topic"]: row for row in keyed.encode_split(split, "good", "bad").collect()}
    assert rows["good"]["key"] == "enwiki" and rows["bad"]["key"] is None
    assert rows["good"]["value"] == keyed.encode_keyed(C.clean_of(split)).first()["value"]
    assert json.loads(rows["bad"]["value"])["reject_reason"] == "missing_user"


def test_latest_per_key(spark):
    records = spark.createDataFrame(
        [("a", "1", 0), ("b", "2", 1), ("a", "3", 5), ("a", "2", 3)], "key string, value string, offset bigint"
    )
    got = {tuple(row) for row in keyed.latest_per_key(records).collect()}
    assert got == {("a", "3", 5), ("b", "2", 1)}


def test_counts_and_tail(spark):
    records = spark.range(100).selectExpr("cast(id as string) as value", "99 - id as offset")
    counts = keyed.topic_counts({"x": records, "none": records.where("false")})
    assert {tuple(row) for row in counts.collect()} == {("x", 100), ("none", 0)}
    assert [row["offset"] for row in keyed.tail(records, 3).collect()] == [0, 1, 2]


def test_compaction_sorts_no_rows(clean):
    plan = keyed.latest_per_key(keyed.encode_keyed(clean))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
