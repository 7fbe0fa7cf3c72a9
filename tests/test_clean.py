import json

import pytest
from pyspark.sql import functions as F

from changefeed import schemas
from changefeed.operators import clean as C

BASE = {
    "wiki": "enwiki", "title": "T", "user": "A", "timestamp": 1700000000, "type": "edit",
    "length": {"old": 100, "new": 90}, "meta": {"domain": "en.example.org"}, "bot": False, "minor": True,
}


def record(**changes):
    edit = {**BASE, **changes}
    return json.dumps({name: value for name, value in edit.items() if value is not ...})


@pytest.fixture
def split(spark):
    def run(*values, lossless=False):
        raw = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset bigint, value string")
        return C.split_raw(raw, lossless)

    return run


GOOD = [
    ({}, {"byte_delta": -10, "new_length": 90, "is_minor": True}),
    ({"length": {"new": 250}, "type": "new"}, {"byte_delta": 250, "new_length": 250}),
    ({"length": ...}, {"byte_delta": 0, "new_length": None}),
    ({"bot": ..., "minor": ...}, {"is_bot": False, "is_minor": False}),
    ({"bot": True}, {"is_bot": True}),
    ({"meta": ...}, {"domain": None}),
    ({"extra": [1, {"a": 2}]}, {"byte_delta": -10}),
    ({"length": "oops"}, {"byte_delta": 0, "new_length": None, "title": "T"}),
    ({"type": "log"}, {"type": "log"}),
    ({"type": "categorize"}, {"type": "categorize"}),
    ({"length": {"old": -2, "new": 2147483647}}, {"byte_delta": -2147483647}),
    ({"timestamp": 9 * 10**18}, {"event_time": None}),
    ({"namespace": 10**12}, {"namespace": None, "title": "T"}),
]


def test_clean(split):
    both = split(*[record(**changes) for changes, _ in GOOD])
    rows = {row["offset"]: row for row in C.clean_of(both).collect()}
    assert len(rows) == len(GOOD) and C.dead_letters_of(both).count() == 0
    for i, (changes, expected) in enumerate(GOOD):
        assert {name: rows[i][name] for name in expected} == expected, changes


def test_huge_numbers_and_deep_nesting_do_not_lose_the_record(split):
    odd = [record(extra=0).replace('"extra": 0', extra) for extra in ('"extra": ' + "9" * 1200, '"extra": ' + "[" * 1200 + "]" * 1200)]
    rows = C.clean_of(split(*odd)).collect()
    assert [row["wiki"] for row in rows] == ["enwiki"] * 2


def test_no_edit_vanishes_when_lossless(split):
    values = [record(), record(timestamp=1700000000 * 10**6), record(timestamp=-(10**15)), record(type=...), "not json"]
    both = split(*values, lossless=True)
    reasons = sorted(row["reject_reason"] for row in C.dead_letters_of(both).collect())
    assert reasons == ["bad_timestamp", "bad_timestamp", "missing_type", "missing_wiki"]
    clean = C.clean_of(both)
    assert clean.count() == 1 and clean.where("event_time is null").count() == 0


def test_clean_columns_and_event_time(split):
    rows = C.clean_of(split(record()))
    assert rows.columns == [*schemas.names(schemas.CLEAN_EDIT), "offset"]
    assert rows.select(F.unix_seconds("event_time").alias("s")).first()["s"] == 1700000000


BAD = [
    ({"wiki": ...}, "missing_wiki"),
    ({"title": None}, "missing_title"),
    ({"user": ...}, "missing_user"),
    ({"timestamp": ...}, "missing_timestamp"),
    ({"timestamp": "soon"}, "missing_timestamp"),
    ({"type": "bogus"}, "unknown_type"),
    ({"wiki": ..., "title": ...}, "missing_wiki"),
    ({"type": ..., "title": ...}, "missing_title"),
    ({"user": ..., "type": "bogus"}, "missing_user"),
]


def test_dead_letters(split):
    both = split(*[record(**changes) for changes, _ in BAD])
    rows = both.where("outlet = 'dlq'").orderBy("offset").collect()
    assert [row["reject_reason"] for row in rows] == [reason for _, reason in BAD]
    assert C.clean_of(both).count() == 0
    assert all(row["rejected_at"] is not None for row in rows)


def test_unreadable_payloads_are_dead_letters(split):
    rows = C.dead_letters_of(split("not json", "", "[1, 2]", '{"wiki": "enwiki", "ti')).collect()
    assert [row["reject_reason"] for row in rows] == ["missing_wiki"] * 4


def test_null_payload_is_a_dead_letter(split):
    assert C.dead_letters_of(split(None, record())).count() == 1


def test_null_type_is_lost_unless_lossless(split):
    assert split(record(type=...)).count() == 0
    rows = C.dead_letters_of(split(record(type=...), lossless=True)).collect()
    assert [row["reject_reason"] for row in rows] == ["missing_type"]
    rows = C.dead_letters_of(split(record(type=..., title=...), lossless=True)).collect()
    assert [row["reject_reason"] for row in rows] == ["missing_title"]


def test_each_payload_is_parsed_once(split):
    plan = C.clean_of(split(record()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
