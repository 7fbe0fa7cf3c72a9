import json
import os
import random
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from changefeed.operators import keyed, stats
from changefeed.operators.wars import edit_wars
from changefeed.__main__ import main as command_line
from changefeed.plans import replay, topics
from changefeed.session import scratch_table
from changefeed.settings import Settings
from changefeed.sources import capture, files
from changefeed.sources.log import StateLog
from changefeed.streaming.jobs import Jobs, finish, run_for
from tests.brute import wars as brute_wars
from tests.test_clean import record
from tests.test_wars import found

T0 = 1700000040
SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
NOW = Settings(bounded=True)


def same(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


class Feed:
    """Clean edits appended batch by batch, each followed by a run of a job."""

    def __init__(self, spark, edits, start, settings=NOW):
        self.jobs = Jobs(spark, scratch_table(spark, "test"), settings)
        self.spark, self.edits, self.start = spark, edits, start

    def add(self, rows):
        df = self.edits(rows)
        df.coalesce(1).write.mode("append").parquet(self.jobs.path("input"))
        return self.run(df.schema)

    def run(self, schema):
        query = self.start(self.jobs, files.read_table(self.spark, self.jobs.path("input"), schema, stream=True))
        finish(query)
        return query


def hand_rows():
    return [
        ("enwiki", "P", "A", False, 10, "edit", T0, 0),
        ("enwiki", "P", "B", True, -4, "edit", T0 + 30, 1),
        ("enwiki", "Q", "A", False, 0, "edit", T0 + 59, 2),
        ("enwiki", "P", "C", False, 1, "edit", T0 + 60, 3),
        ("dewiki", "R", "D", False, None, "new", T0, 4),
        ("enwiki", "P", "A", False, 1, "edit", T0 + 200, 5),
    ]


def closer(second, offset=10**6):
    return [("closer", "C", "C", False, 0, "edit", second, offset)]


def dropped(query):
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in json.loads(p.json)["stateOperators"])


def test_windows_close_late_rows_drop_and_restart_adds_nothing(spark, edits):
    feed = Feed(spark, edits, Jobs.start_stats)
    feed.add(hand_rows())
    feed.add(closer(T0 + 2000))
    real = lambda: spark.read.parquet(feed.jobs.path("stats")).where("wiki <> 'closer'")
    want = stats.wiki_stats(edits(hand_rows()))
    assert same(real(), want)

    late = feed.add([("enwiki", "P", "A", False, 5, "edit", T0 + 10, 6)] + closer(T0 + 2300))
    assert dropped(late) >= 1
    assert same(real(), want)

    feed.run(edits(hand_rows()).schema)
    assert same(real(), want)


def test_open_windows_are_not_reported(spark, edits):
    feed = Feed(spark, edits, Jobs.start_stats)
    feed.add(hand_rows())
    starts = {r["s"] for r in spark.read.parquet(feed.jobs.path("stats")).select(F.unix_seconds("window_start").alias("s")).collect()}
    assert T0 in starts and T0 + 180 not in starts


def test_upserts_show_early_windows_and_correct_them(spark, edits):
    feed = Feed(spark, edits, Jobs.start_stats_upserts)
    rows = hand_rows()
    feed.add(rows[:2])
    assert same(feed.jobs.corrected_stats(), stats.wiki_stats(edits(rows[:2])))
    feed.add(rows[2:])
    assert same(feed.jobs.corrected_stats(), stats.wiki_stats(edits(rows)))


def war_rows(seed, n=400, pages=3):
    rnd = random.Random(seed)
    second, rows = T0, []
    for i in range(n):
        second += rnd.choice([0, 1, 2, 150, 599])
        rows.append(("w", f"P{rnd.randrange(pages)}", f"u{rnd.randrange(2)}", rnd.random() < 0.05, rnd.randrange(-9, 9), "edit", second, i))
    return rows


def test_wars_on_a_stream_equal_the_batch(spark, edits):
    rows = war_rows(1)
    feed = Feed(spark, edits, Jobs.start_wars)
    for at in range(0, 400, 100):
        feed.add(rows[at : at + 100])
    feed.add(closer(rows[-1][6] + 10**6))
    want = brute_wars(rows, 600)
    assert len(want) > 20
    assert found(spark.read.parquet(feed.jobs.path("wars"))) == want
    assert found(edit_wars(edits(rows))) == want
    feed.run(edits(rows).schema)
    assert found(spark.read.parquet(feed.jobs.path("wars"))) == want


def test_wars_are_reported_once_the_watermark_has_passed(spark, edits):
    """The page need not fall silent first."""
    rows = [("w", "P", "AB"[i % 2], False, 1, "edit", T0 + i * 20, i) for i in range(30)]
    feed = Feed(spark, edits, Jobs.start_wars)
    feed.add(rows)
    got = found(spark.read.parquet(feed.jobs.path("wars")))
    assert got == brute_wars(rows, 600)[: len(got)] and len(got) >= 8


def test_late_edits_make_no_match(spark, edits):
    feed = Feed(spark, edits, Jobs.start_wars)
    feed.add([("w", "P", "A", False, 1, "edit", T0 + 1000, 0)])
    query = feed.add([("w", "P", user, False, 1, "edit", T0 + 10 * i, i + 1) for i, user in enumerate("ABA")])
    feed.add(closer(T0 + 10**6))
    assert dropped(query) == 3
    assert found(spark.read.parquet(feed.jobs.path("wars"))) == []


def test_out_of_order_within_the_delay(spark, edits):
    rows = war_rows(2, n=120, pages=1)
    rows = [(*r[:6], T0 + i * 10, i) for i, r in enumerate(rows)]
    shuffled = [row for i in range(0, 120, 2) for row in (rows[i + 1], rows[i])]
    feed = Feed(spark, edits, Jobs.start_wars)
    feed.add(shuffled[:61])
    feed.add(shuffled[61:])
    feed.add(closer(T0 + 10**6))
    assert found(spark.read.parquet(feed.jobs.path("wars"))) == brute_wars(rows, 600)


@pytest.fixture
def capture_folder(tmp_path):
    folder = tmp_path / "captures"
    folder.mkdir()
    values = [record(title=f"T{i}", timestamp=1700000000 + i) for i in range(40)]
    values[3], values[5] = "not json", record(user=...)
    for part in range(4):
        blocks = [f"id: {i}\ndata: {values[i]}\n\n" for i in range(part * 10, part * 10 + 10)]
        path = folder / f"capture-{part}.txt"
        path.write_text("".join(blocks))
        os.utime(path, (1700000000 + part, 1700000000 + part))
    return str(folder)


def test_ingest_and_clean_jobs(spark, capture_folder):
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    finish(jobs.start_ingest(capture_folder, files_per_trigger=2))
    assert (jobs.ingested["received"], jobs.ingested["produced"], jobs.ingested["skipped"]) == (40, 39, 1)
    raw = files.raw_records(spark, jobs.path("raw"))
    rows = raw.orderBy("offset").collect()
    assert [json.loads(row["value"])["title"] for row in rows] == [f"T{i}" if i != 5 else "T" for i in range(40) if i != 3]
    assert {row["key"] for row in rows} == {"enwiki"}

    finish(jobs.start_ingest(capture_folder, files_per_trigger=2))
    assert files.raw_records(spark, jobs.path("raw")).count() == 39

    stream = files.raw_records(spark, jobs.path("raw"), stream=True, per_trigger=1)
    finish(jobs.start_clean(stream))
    assert jobs.clean_edits(stream=False).count() == 38
    split = files.split_edits_table(spark, jobs.path("edits"))
    assert [r["reject_reason"] for r in split.where("outlet = 'dlq'").collect()] == ["missing_user"]


def titles(spark, jobs):
    rows = files.raw_records(spark, jobs.path("raw")).orderBy("offset").collect()
    return [json.loads(row["value"])["title"] for row in rows]


def add_capture(folder, part, first, count):
    path = os.path.join(folder, f"capture-{part}.txt")
    with open(path, "w") as file:
        file.write("".join(f"id: {i}\ndata: {record(title=f'T{i}')}\n\n" for i in range(first, first + count)))
    os.utime(path, (1700000000 + part, 1700000000 + part))


def test_ingest_appends_and_resumes(spark, tmp_path):
    """A stream, single runs and the stream again lose nothing and double nothing."""
    folder = tmp_path / "captures"
    folder.mkdir()
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    add_capture(folder, 0, 0, 20)
    finish(jobs.start_ingest(str(folder)))
    add_capture(folder, 1, 20, 10)
    counted = jobs.ingest_once(str(folder), max_events=3)
    assert (counted["received"], counted["produced"]) == (3, 3)
    assert titles(spark, jobs) == [f"T{i}" for i in range(23)]
    assert jobs.ingest_once(str(folder), max_events=2)["received"] == 2
    add_capture(folder, 2, 30, 4)
    finish(jobs.start_ingest(str(folder)))
    assert titles(spark, jobs) == [f"T{i}" for i in range(34)]
    finish(Jobs(spark, jobs.root, NOW).start_ingest(str(folder)))
    assert titles(spark, jobs) == [f"T{i}" for i in range(34)]
    assert jobs.ingest_once(str(folder))["received"] == 0
    assert StateLog(spark, jobs.path("raw_log")).read()["last_event_id"] == "33"
    assert jobs.ingest_rate() > 0


def test_batches_without_end_and_run_again(spark, tmp_path):
    folder = tmp_path / "captures"
    folder.mkdir()
    add_capture(folder, 0, 0, 5)
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    lines = capture.read_capture(spark, str(folder))
    for batch_id in (10_000_000, 10_000_000, 9_999_999):
        jobs._append(lines, (), False, batch_id=batch_id)
    assert titles(spark, jobs) == [f"T{i}" for i in range(5)]
    assert jobs.ingested["received"] == 5


def test_an_announced_batch_counts_if_it_is_complete(spark, tmp_path):
    folder = tmp_path / "captures"
    folder.mkdir()
    add_capture(folder, 0, 0, 5)
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    log = StateLog(spark, jobs.path("raw_log"))
    jobs.ingest_once(str(folder))
    done = log.read()
    # the driver stopped after the rows were written but before they were counted
    log.write({"pending": {"folder": jobs.path("raw/batch=000000000001"), "state": done}})
    assert jobs.ingest_once(str(folder))["received"] == 0
    assert titles(spark, jobs) == [f"T{i}" for i in range(5)]
    # and here before they were complete
    add_capture(folder, 1, 5, 2)
    log.write(done | {"pending": {"folder": jobs.path("raw/batch=000000000009"), "state": {}}})
    assert jobs.ingest_once(str(folder))["received"] == 2
    assert titles(spark, jobs) == [f"T{i}" for i in range(7)]


def test_a_backlog_takes_several_batches(spark, edits, tmp_path):
    rows = war_rows(5, n=200) + closer(T0 + 10**6)
    jobs = Jobs(spark, scratch_table(spark, "test"), Settings(bounded=True, bytes_per_trigger=1))
    for at in range(0, len(rows), 50):
        edits(rows[at : at + 50]).coalesce(1).write.mode("append").parquet(jobs.path("input"))
    schema = edits(rows[:1]).schema
    stream = files.read_table(spark, jobs.path("input"), schema, stream=True, per_trigger=jobs.settings.bytes_per_trigger)
    query = jobs.start_wars(stream)
    finish(query)
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 5
    assert found(spark.read.parquet(jobs.path("wars"))) == brute_wars(rows, 600)


def test_late_edits_are_counted(spark, edits):
    feed = Feed(spark, edits, Jobs.start_stats)
    feed.add(hand_rows())
    feed.add(closer(T0 + 2000))
    feed.add([("enwiki", "P", "A", False, 5, "edit", T0 + 10, 6)] + closer(T0 + 2300))
    for _ in range(300):
        if feed.jobs.progress.late["stats"]:
            break
        time.sleep(0.1)
    assert feed.jobs.progress.late["stats"] >= 1 and feed.jobs.progress.rows["stats"] >= 8


def test_late_edits_are_kept(spark, edits):
    """What is judged on time is what the statistics stream counts; on time and late together are all."""
    rows, late = hand_rows(), ("enwiki", "P", "A", False, 5, "edit", T0 + 10, 6)
    untimed = ("enwiki", "P", "A", False, 5, "edit", None, 8)
    increments = [rows, closer(T0 + 2000), [late, *closer(T0 + 2300, 7), untimed], [("enwiki", "P", "A", False, 5, "edit", T0 + 2290, 9)]]
    judging, counting = Feed(spark, edits, Jobs.start_judged), Feed(spark, edits, Jobs.start_stats)
    for increment in increments:
        judging.add(increment)
        counting.add(increment)
    schema = edits(rows).schema
    judging.run(schema)
    judged = judging.jobs.judged(schema)
    outlets = {r["offset"]: r["outlet"] for r in judged.collect()}
    assert sorted(outlets) == sorted(row[7] for increment in increments for row in increment)
    assert judged.count() == len(outlets)
    assert {o for o, outlet in outlets.items() if outlet == "late"} == {6}
    assert {o for o, outlet in outlets.items() if outlet == "untimed"} == {8}
    counting.add(closer(T0 + 10**5, 11))
    counted = spark.read.parquet(counting.jobs.path("stats")).where("wiki <> 'closer'")
    on_time = judged.where("outlet = 'on_time' and wiki <> 'closer'").drop("outlet", "batch")
    assert same(counted, stats.wiki_stats(on_time))
    plan = judged.where("outlet = 'late'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outlet" in plan


def test_a_judged_batch_is_stored_once(spark, edits):
    """The driver stops behind the rename: the batch that comes again is counted, not written again."""
    feed = Feed(spark, edits, Jobs.start_judged)
    feed.add(hand_rows())
    log = StateLog(spark, feed.jobs.path("judged_log"))
    before = log.read()
    feed.add(closer(T0 + 2000))
    after = log.read()
    log.write(before)
    checkpoint = feed.jobs.path("_checkpoints/judged/commits").removeprefix("file:")
    last = max((n for n in os.listdir(checkpoint) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(checkpoint, name)):
            os.remove(os.path.join(checkpoint, name))
    feed.run(edits(hand_rows()).schema)
    assert log.read() == after
    assert feed.jobs.judged(edits(hand_rows()).schema).count() == len(hand_rows()) + 1


def test_held_state_before_and_after_a_restart(spark, edits):
    feed = Feed(spark, edits, Jobs.start_wars)
    rows = [("w", f"P{page}", "AB"[k % 2], False, 1, "edit", T0 + 20 * k, 10 * page + k) for page in range(3) for k in range(4)]
    feed.add(rows)
    held = {r["variable"]: r for r in feed.jobs.held_state().collect()}
    assert set(held) == {"done", "waiting"} and held["done"]["rows"] == 3
    assert 3 <= held["waiting"]["rows"] <= 12
    assert held["done"]["watermark"].timestamp() == T0 + 60 - 15
    feed.run(edits(rows).schema)
    again = {r["variable"]: r for r in feed.jobs.held_state().collect()}
    assert all((again[v]["rows"], again[v]["watermark"]) == (held[v]["rows"], held[v]["watermark"]) for v in held)
    feed.add(closer(T0 + 10**6))
    last = {r["variable"]: r for r in feed.jobs.held_state().collect()}
    assert last["done"]["rows"] == last["waiting"]["rows"] == 1 and last["done"]["batch"] > held["done"]["batch"]
    assert Jobs(spark, scratch_table(spark, "test"), NOW).held_state().collect() == []


def test_state_written_follows_new_edits(spark, edits):
    """A page with many waiting edits: each batch adds its own few, the others are not written again."""
    from changefeed.streaming import state

    settings = Settings(bounded=True, out_of_order_seconds=10_000)
    feed = Feed(spark, edits, Jobs.start_wars, settings)
    checkpoint = feed.jobs.path("_checkpoints/wars").removeprefix("file:")
    rows, written = [], []
    for k in range(6):
        batch = [("w", "P", f"u{i % 7}", False, 1, "edit", T0 + 300 * k + i // 10, 1000 * k + i) for i in range(600 if k == 0 else 20)]
        rows += batch
        files_before = {p: p.stat().st_size for p in Path(checkpoint, "state").rglob("*.changelog")}
        feed.add(batch)
        new = [p for p in Path(checkpoint, "state").rglob("*.changelog") if p not in files_before]
        written.append(sum(p.stat().st_size for p in new))
        assert state.held_rows(spark, feed.jobs.path("_checkpoints/wars"), 0, "waiting").count() == len(rows)
    assert 0 < max(written[1:]) < written[0] / 3
    feed.add(closer(T0 + 10**6))
    assert found(spark.read.parquet(feed.jobs.path("wars"))) == brute_wars(rows, 600)


def test_parts_are_compacted(spark, edits):
    rows = hand_rows()
    sent = {}

    def send(changed):
        sent.update({r["key"]: r["value"] for r in keyed.encode_upsert(changed).collect()})

    feed = Feed(spark, edits, lambda jobs, clean: jobs.start_stats_upserts(clean, compact_every=2, send=send))
    for row in rows:
        feed.add([row])
    final = keyed.encode_upsert(stats.wiki_stats(edits(rows))).collect()
    assert sent == {r["key"]: r["value"] for r in final}
    assert same(feed.jobs.corrected_stats(), stats.wiki_stats(edits(rows)))
    state = StateLog(spark, feed.jobs.path("stats_log")).read()
    assert all(len(day["folders"]) < 2 for day in state["days"].values())
    kept = os.listdir(feed.jobs.path("stats_parts").removeprefix("file:"))
    assert len(kept) <= 6
    newest = feed.jobs._newest_parts(state["days"]).agg(F.max("batch")).first()[0]
    changed = feed.jobs.changed_stats(newest - 1)
    assert 0 < changed.count() < feed.jobs.corrected_stats().count()
    assert changed.exceptAll(feed.jobs.corrected_stats()).count() == 0


def bytes_read(spark, group):
    """Input metrics of the jobs run under a group name."""
    store, tracker = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return sum(store.lastStageAttempt(s).inputBytes() for s in stages if tracker.getStageInfo(s))


def test_cost_of_corrections_does_not_grow_with_history(spark, edits):
    """A batch reads the days it changes, and a day that is over is written together once and then left alone."""
    sc, day, seen = spark.sparkContext, 24 * 3600, []

    def send(changed):
        sc.setJobGroup(f"send-{id(seen)}-{len(seen)}", "")
        seen.append({(r["wiki"], r["edits"]) for r in changed.collect()})

    feed = Feed(spark, edits, lambda jobs, clean: jobs.start_stats_upserts(clean, compact_every=4, send=send))
    folder = feed.jobs.path("stats_parts").removeprefix("file:")
    rows, history = [], []
    for k in range(9):
        batch = [("w", f"P{i}", f"u{i}", False, 1, "edit", T0 + k * day + i // 40, k * 1000 + i) for i in range(200)]
        feed.add(batch)
        more = [("w", "P0", "late", False, 1, "edit", T0 + k * day + 10, k * 1000 + 999)]
        feed.add(more)
        rows += batch + more
        state = StateLog(spark, feed.jobs.path("stats_log")).read()
        history.append({d: known["folders"] for d, known in state["days"].items()})
    assert same(feed.jobs.corrected_stats(), stats.wiki_stats(edits(rows)))
    read = [bytes_read(spark, f"send-{id(seen)}-{k}") for k in range(len(seen))]
    assert len(read) >= 18 and 0 < max(read[-6:]) < 1.1 * max(read[2:8])
    first_day = min(history[-1])
    settled = [state[first_day] for state in history[2:]]
    assert all(len(folders) == 1 for folders in settled) and len({tuple(f) for f in settled}) == 1
    assert all(len(os.listdir(os.path.join(folder, name))) for name in os.listdir(folder))
    assert {wiki for changed in seen for wiki, _ in changed} == {"w"}


def test_nulls_give_the_same_on_a_stream_and_in_a_batch(spark, edits):
    rows = []
    for page, (users, bots, deltas) in enumerate(
        [
            (("A", None, "A"), (False,) * 3, (1, 2, 3)),
            ((None, "B", None), (False,) * 3, (1, 2, 3)),
            (("A", "B", "A"), (None, False, False), (1, 2, 3)),
            (("A", "B", "A"), (False, None, False), (1, 2, 3)),
            (("A", "B", "A"), (False, False, None), (1, 2, 3)),
            (("A", "B", "A"), (False,) * 3, (1, None, 3)),
            (("A", "B", "A"), (False,) * 3, (None, 2, 3)),
            (("A", "B", "A"), (False,) * 3, (1, 2, None)),
        ]
    ):
        for k in range(3):
            rows.append(("w", f"P{page}", users[k], bots[k], deltas[k], "edit", T0 + k, 10 * page + k))
    feed = Feed(spark, edits, Jobs.start_wars)
    feed.add(rows)
    feed.add(closer(T0 + 10**6))
    batch = edit_wars(edits(rows))
    assert batch.count() == 4
    assert same(spark.read.parquet(feed.jobs.path("wars")), batch)


def test_wars_start_from_any_folder(tmp_path):
    """Only the driver knows where the package lies; executors get it from the session."""
    root = Path(__file__).resolve().parents[1]
    script = tmp_path / "run.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {str(root)!r})
from changefeed.session import build_session, scratch_table
import __spark_entry__ as entry
spark = build_session(master="local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": {str(tmp_path / "shared")!r}}})
print("rows", entry.queries()["stream_wars"](spark, {SF_DIR!r}).count())
"""
    )
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]


def test_command_line(spark, capture_folder, tmp_path, capsys):
    root = str(tmp_path / "root")
    for job in ("ingest", "clean", "stats", "wars", "judge"):
        command_line([job, "--root", root, "--captures", capture_folder, "--bounded"])
    assert spark.read.parquet(f"{root}/edits").count() == 39
    command_line(["replay", "--root", root])
    command_line(["counts", "--root", root])
    assert "wiki.edits.clean" in capsys.readouterr().out
    assert spark.read.parquet(f"{root}/judged").count() == 38
    command_line(["state", "--root", root])
    shown = capsys.readouterr().out
    assert "stateStoreSave" in shown and "waiting" in shown and "4 capture files taken, last event id 39" in shown
    command_line(["tail", "--root", root, "--table", "replay/stats"])
    assert "enwiki" in capsys.readouterr().out


def test_topic_to_topic(spark, tmp_path):
    """Records of one job are the input of the next, bounded and as streams."""
    values = [record(user="AB"[i % 2], timestamp=1700000000 + i * 20) for i in range(10)] + [record(user=...)]
    raw = spark.createDataFrame([("enwiki", v, i) for i, v in enumerate(values)], "key string, value string, offset bigint")
    settings = Settings()
    both = topics.clean_records(raw, settings)
    clean = both.where(F.col("topic") == settings.topic("clean")).drop("topic")
    assert (both.count(), clean.count()) == (11, 10)
    stat_values = [json.loads(r["value"]) for r in topics.stats_records(clean, settings).collect()]
    assert sorted(v["edits"] for v in stat_values) == [2, 2, 3, 3]
    want = {r["value"] for r in topics.war_records(clean, settings).collect()}
    assert {(json.loads(v)["reverter"], json.loads(v)["seconds_elapsed"]) for v in want} == {("A", 40), ("B", 40)}

    jobs = Jobs(spark, str(tmp_path / "root"), NOW)
    end = raw.limit(1).select("key", F.lit(record(title="end", timestamp=1700100000)).alias("value"), F.lit(99).cast("bigint").alias("offset"))
    topics.clean_records(raw.unionByName(end), settings).where("key is not null").drop("topic").write.parquet(jobs.path("topic"))
    stream = files.read_table(spark, jobs.path("topic"), clean.schema, stream=True)
    writer = topics.war_records(stream, settings).writeStream.format("parquet").option("path", jobs.path("alerts"))
    finish(jobs.start_records(writer, "wars"))
    assert {r["value"] for r in spark.read.parquet(jobs.path("alerts")).collect()} == want


def test_replay_can_be_repeated(spark, tmp_path):
    raw = spark.createDataFrame(
        [(i, record(user="AB"[i % 2], timestamp=1700000000 + i * 20)) for i in range(10)] + [(10, record(user=...))],
        "offset bigint, value string",
    )
    root = str(tmp_path / "root")
    for _ in range(2):
        replay.replay(raw, root)
    counts = {row["topic"]: row["records"] for row in replay.counts(spark, raw, root).collect()}
    assert counts == {
        "wiki.edits.raw": 11, "wiki.edits.clean": 10, "wiki.edits.dlq": 1,
        "wiki.stats.per_wiki_1m": 4, "wiki.alerts.edit_wars": 3,
    }


def test_one_outlet_is_read_by_itself(spark, tmp_path):
    raw = spark.createDataFrame([(0, record()), (1, record(user=...))], "offset bigint, value string")
    replay.replay_clean(raw, str(tmp_path / "r"))
    plan = replay.clean_table(spark, str(tmp_path / "r"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outlet" in plan
    assert "rejected_at" not in plan.split("ReadSchema")[1]


def test_running_for_a_while(spark, edits):
    df = edits(hand_rows())
    jobs = Jobs(spark, scratch_table(spark, "test"), Settings(trigger_seconds=1))
    df.write.parquet(jobs.path("input"))
    query = jobs.start_stats(files.read_table(spark, jobs.path("input"), df.schema, stream=True))
    run_for(query, 4)
    assert not query.isActive


def test_wars_keep_their_state_in_rocksdb_whatever_the_session_says(spark, edits):
    """Found by the review: a session with Spark's default state store could not run the job."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before, plain = spark.conf.get(name), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(name, plain)
    try:
        feed = Feed(spark, edits, Jobs.start_wars)
        feed.add([("w", "P", user, False, 1, "edit", T0 + at, at) for at, user in enumerate("ABA")])
        feed.add([("w", "closer", "C", False, 1, "edit", T0 + 10_000, 9)])
        assert [row["reverter"] for row in spark.read.parquet(feed.jobs.path("wars")).collect()] == ["A"]
        assert spark.conf.get(name) == plain
    finally:
        spark.conf.set(name, before)
