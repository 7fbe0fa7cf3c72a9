import random

import pytest
from pyspark.sql import functions as F

from changefeed import schemas
from changefeed.operators import stats

T0 = 1700000040  # starts a minute


def as_dicts(df):
    keep = [F.unix_seconds("window_start").alias("start"), *schemas.names(schemas.WIKI_STATS)[2:]]
    return {(row["wiki"], row["start"]): row.asDict() for row in df.select(*keep).collect()}


def test_hand_rows(edits):
    rows = [
        ("enwiki", "P", "A", False, 10, "edit", T0, 0),
        ("enwiki", "P", "B", True, -4, "edit", T0 + 30, 1),
        ("enwiki", "Q", "A", False, 0, "edit", T0 + 59, 2),
        ("enwiki", "P", "C", False, 1, "edit", T0 + 60, 3),
        ("dewiki", "R", "D", False, None, "new", T0, 4),
    ]
    got = as_dicts(stats.wiki_stats(edits(rows)))
    assert got[("enwiki", T0)] == {
        "start": T0, "wiki": "enwiki", "edits": 3, "bot_edits": 1, "human_edits": 2, "editors": 2,
        "pages_touched": 2, "new_pages": 0, "bytes_added": 10, "bytes_removed": -4, "net_bytes": 6,
        "bot_share_pct": 33.33,
    }
    assert got[("enwiki", T0 + 60)]["edits"] == 1
    german = got[("dewiki", T0)]
    assert (german["edits"], german["new_pages"], german["net_bytes"], german["bytes_added"]) == (1, 1, 0, 0)
    assert german["bot_share_pct"] == 0.0
    assert len(got) == 3


def test_types(edits):
    df = stats.wiki_stats(edits([("w", "P", "A", False, 1, "edit", T0, 0)]))
    assert [(n, t.upper()) for n, t in df.dtypes] == schemas.fields(schemas.WIKI_STATS)


def test_sums_beyond_32_bits(edits):
    rows = [("w", "P", "A", False, 2**31 - 1, "edit", T0, i) for i in range(5)]
    assert as_dicts(stats.wiki_stats(edits(rows)))[("w", T0)]["net_bytes"] == 5 * (2**31 - 1)


def test_null_members_are_not_counted(edits):
    rows = [("w", None, None, None, 1, "edit", T0, 0), ("w", "P", None, True, 1, "edit", T0, 1)]
    row = as_dicts(stats.wiki_stats(edits(rows)))[("w", T0)]
    assert (row["edits"], row["editors"], row["pages_touched"]) == (2, 0, 1)
    assert (row["bot_edits"], row["human_edits"]) == (1, 0)


@pytest.mark.parametrize("minutes", [1, 7])
def test_against_plain_python(edits, minutes):
    rnd = random.Random(minutes)
    rows = [
        (
            "hot" if rnd.random() < 0.4 else f"w{rnd.randrange(3)}", f"P{rnd.randrange(9)}", f"u{rnd.randrange(6)}",
            rnd.random() < 0.3, rnd.choice([None, rnd.randrange(-99, 99)]), rnd.choice(["edit", "new", "log"]),
            T0 + rnd.randrange(1500), i,
        )
        for i in range(1500)
    ]
    want = {}
    for wiki, title, user, is_bot, delta, kind, second, _ in rows:
        key = (wiki, second // (60 * minutes) * 60 * minutes)
        want.setdefault(key, []).append((title, user, is_bot, delta or 0, kind))
    got = as_dicts(stats.wiki_stats(edits(rows), window_minutes=minutes))
    assert got.keys() == want.keys()
    for key, group in want.items():
        row, bots = got[key], sum(e[2] for e in group)
        assert row["edits"] == len(group) and row["bot_edits"] == bots
        assert row["editors"] == len({e[1] for e in group})
        assert row["pages_touched"] == len({e[0] for e in group})
        assert row["new_pages"] == sum(e[4] == "new" for e in group)
        assert row["bytes_added"] == sum(max(e[3], 0) for e in group)
        assert row["bytes_removed"] == sum(min(e[3], 0) for e in group)
        assert row["bot_share_pct"] == (20000 * bots + len(group)) // (2 * len(group)) / 100


def test_approximate_counts_are_close(edits):
    rows = [("w", f"P{i % 700}", f"u{i % 300}", False, 1, "edit", T0, i) for i in range(3000)]
    row = as_dicts(stats.wiki_stats(edits(rows), approx=True))[("w", T0)]
    assert abs(row["editors"] - 300) <= 15 and abs(row["pages_touched"] - 700) <= 35
    assert row["edits"] == 3000


@pytest.mark.parametrize("minutes", [0, -5, "1"])
def test_window_must_be_positive(edits, minutes):
    with pytest.raises(ValueError):
        stats.wiki_stats(edits([("w", "P", "A", False, 1, "edit", T0, 0)]), window_minutes=minutes)


def test_sketches_of_many_members_stay_within_their_error(spark):
    """Minutes united into a day: thousands of editors and pages, three standard errors of 1.6 %."""
    n = 60_000
    edits = spark.range(n).select(
        F.lit("w").alias("wiki"),
        F.concat(F.lit("p"), F.col("id") % 9_000).alias("title"),
        F.concat(F.lit("u"), (F.col("id") * 7919) % 23_000).alias("user"),
        (F.col("id") % 5 == 0).alias("is_bot"),
        F.lit(1).alias("byte_delta"),
        F.lit("edit").alias("type"),
        F.timestamp_seconds(F.lit(1_700_006_400) + F.col("id") % 86_400).alias("event_time"),
    )
    minutes = stats.sketched_stats(edits)
    (row,) = stats.estimated(stats.widen(stats.widen(minutes, 60), 1440)).collect()
    (exact,) = stats.wiki_stats(edits, 1440).collect()
    assert (exact["editors"], exact["pages_touched"]) == (23_000, 9_000)
    for name in ("editors", "pages_touched"):
        assert 0 < abs(row[name] - exact[name]) < 0.05 * exact[name]
    same = [name for name in exact.asDict() if name not in ("editors", "pages_touched")]
    assert [row[name] for name in same] == [exact[name] for name in same]
    approx = stats.wiki_stats(edits, 1440, approx=True).first()
    assert abs(approx["editors"] - 23_000) < 0.03 * 23_000 and abs(approx["pages_touched"] - 9_000) < 0.03 * 9_000


def test_wide_windows_read_only_the_minute_table(spark, edits, tmp_path):
    stats.sketched_stats(edits([("w", "P", f"u{k}", False, 1, "edit", 1_700_000_000 + 50 * k, k) for k in range(200)])).write.parquet(f"{tmp_path}/minutes")
    wide = stats.widen(spark.read.parquet(f"{tmp_path}/minutes"), 1440)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "user" not in plan
    assert [name.rpartition("/")[0].rpartition("/")[2] for name in wide.inputFiles()][0] == "minutes"
    assert stats.estimated(wide).agg(F.sum("editors")).first()[0] == 200
