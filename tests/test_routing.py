import pytest

from changefeed.operators import routing

PAYLOADS = [
    ('{"wiki":"enwiki"}', "enwiki"),
    ('{"wiki":"","meta":{"domain":"d"}}', "d"),
    ('{"meta":{"domain":""}}', "unknown"),
    ("{}", "unknown"),
    ('{"wiki":null,"meta":null}', "unknown"),
    ('{"wiki":"dewiki","title":"[[a]] } ]"}', "dewiki"),
    ('  {"wiki":"padded"}  ', "padded"),
    ("not json", None),
    ("", None),
    ('{"wiki":"x"', None),
    ('{"wiki":"x"} trailing', None),
    ('{"wiki":"x"}, {"wiki":"y"}', None),
    ('{"wiki":"x"}] [', None),
    ('{"wiki":"x"}, "v": 1', None),
    ("[1]", None),
    ('"text"', None),
    ("5", None),
    ("null", None),
    ('{"wiki":"first","wiki":"second"}', "second"),
    ('{"wiki":"nan","size":NaN}', "nan"),
    ('{"wiki":"digits","n":' + "7" * 1200 + "}", "digits"),
    ('{"wiki":"nested","n":' + "[" * 1200 + "]" * 1200 + "}", "nested"),
]


def test_very_long_strings(spark):
    row = [('{"wiki":"long","comment":"' + "x" * 21_000_000 + '"}',)]
    events = spark.createDataFrame(row, "data string")
    assert routing.ingest_metrics(events).first()["produced"] == 1


@pytest.fixture
def events(spark):
    rows = [(i, payload) for i, (payload, _) in enumerate(PAYLOADS)]
    return spark.createDataFrame(rows, "offset bigint, data string")


def test_keys(events):
    got = {row["offset"]: (row["value"], row["key"]) for row in routing.route_raw(events).collect()}
    assert got == {i: case for i, case in enumerate(PAYLOADS) if case[1] is not None}


def test_allow_list_uses_the_key_before_its_default(events):
    kept = {row["key"] for row in routing.route_raw(events, {"enwiki", "d", "unknown"}).collect()}
    assert kept == {"enwiki", "d"}


def test_limit_counts_events_before_filtering(events):
    first = routing.first_events(events, 8)
    assert routing.route_raw(first).count() == 7
    assert routing.ingest_metrics(first).first()["received"] == 8


def test_limit_falls_inside_a_block(spark):
    events = spark.range(0, 400_000, 2).selectExpr("id as offset", "cast(id as string) as data").repartition(5)
    for n in (1, 32_768, 32_769, 100_000, 10**6):
        row = routing.first_events(events, n).selectExpr("count(*) n", "max(offset) last").first()
        assert (row["n"], row["last"]) == (min(n, 200_000), 2 * min(n, 200_000) - 2)


def test_metrics(events):
    row = routing.ingest_metrics(events).first()
    assert (row["received"], row["produced"], row["skipped"]) == (22, 11, 11)
    assert row["bytes_in"] == sum(len(payload) for payload, _ in PAYLOADS)
    assert routing.ingest_metrics(events, {"dewiki"}).first()["produced"] == 1


def test_metrics_count_characters(spark):
    events = spark.createDataFrame([('{"t":"漢ü😀"}',)], "data string")
    assert routing.ingest_metrics(events).first()["bytes_in"] == len('{"t":"漢ü😀"}')


def test_metrics_of_nothing(events):
    row = routing.ingest_metrics(events.where("false")).first()
    assert tuple(row) == (0, 0, 0, 0)
