"""Ingest by file positions: any order of names, grown files, whole batches only."""

import os
import random

import pytest
from pyspark.sql import functions as F

from changefeed.session import scratch_table
from changefeed.settings import Settings
from changefeed.sources import capture, files
from changefeed.sources.log import StateLog
from changefeed.streaming.jobs import Jobs, finish
from tests.test_clean import record
from tests.test_streaming import NOW, titles


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "captures").mkdir()
    return tmp_path / "captures"


def capture_file(folder, name, first, count, second, end="\n\n", more=""):
    blocks = [f"id: {i}\ndata: {record(title=f'T{i}')}" for i in range(first, first + count)]
    path = folder / name
    path.write_text("".join(block + end for block in blocks) + more)
    os.utime(path, (1700000000 + second, 1700000000 + second))


def numbers(spark, jobs):
    return sorted(int(title[1:]) for title in titles(spark, jobs))


def opened(spark, jobs, captures):
    """Names of the files that the next single run would open."""
    from changefeed.plans.ingest import unread_files

    return {os.path.basename(path) for path in unread_files(spark, str(captures), jobs.positions())}


def test_names_need_not_sort(spark, folder):
    """capture-10 after capture-9, and a second host whose names come first."""
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    capture_file(folder, "capture-9.txt", 0, 5, 0)
    assert jobs.ingest_once(str(folder))["received"] == 5
    capture_file(folder, "capture-10.txt", 5, 5, 10)
    capture_file(folder, "a-second-host.txt", 10, 5, 5)
    assert opened(spark, jobs, folder) == {"capture-10.txt", "a-second-host.txt"}
    assert jobs.ingest_once(str(folder), max_events=7)["received"] == 7
    assert titles(spark, jobs) == [f"T{i}" for i in (*range(5), *range(10, 15), 5, 6)]
    assert opened(spark, jobs, folder) == {"capture-10.txt"}
    capture_file(folder, "capture-09.txt", 20, 3, -100)
    finish(jobs.start_ingest(str(folder)))
    assert numbers(spark, jobs) == [*range(15), 20, 21, 22]
    assert opened(spark, jobs, folder) == set()
    assert jobs.ingest_once(str(folder))["received"] == 0
    assert jobs.resume_position() == "9"


def test_a_file_that_grows_is_taken_on(spark, folder):
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    capture_file(folder, "live.txt", 0, 3, 0, more="id: 3\ndata: cut o")
    assert jobs.ingest_once(str(folder))["received"] == 3
    assert opened(spark, jobs, folder) == set()
    capture_file(folder, "live.txt", 0, 6, 1)
    capture_file(folder, "other.txt", 6, 2, 2)
    assert jobs.ingest_once(str(folder), max_events=2)["received"] == 2
    assert opened(spark, jobs, folder) == {"live.txt", "other.txt"}
    assert jobs.ingest_once(str(folder))["received"] == 3
    assert titles(spark, jobs) == [f"T{i}" for i in range(8)]


def test_runs_of_any_size_take_everything_once(spark, folder):
    """Limits that fall anywhere, streams in between, blocks without events, splits of another size each time."""
    rng = random.Random(3)
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    for part, name in enumerate(("c", "a", "d", "b")):
        capture_file(folder, f"{name}.txt", 10 * part, 10, part, more=":ok\n\n" * part, end=rng.choice(["\n\n", "\n\n\n"]))
    try:
        for turn in range(6):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(rng.choice([300, 900, 10**6])))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            before = jobs.ingested["received"]
            assert jobs.ingest_once(str(folder), max_events=7)["received"] == min(7, 40 - before)
            if turn == 3:
                capture_file(folder, "0.txt", 40, 4, 9)
                finish(jobs.start_ingest(str(folder)))
                break
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert numbers(spark, jobs) == list(range(44))
    assert titles(spark, jobs)[:28] == [f"T{i}" for i in range(28)]
    offsets = [r["offset"] for r in files.raw_records(spark, jobs.path("raw")).collect()]
    assert len(set(offsets)) == 44


def test_positions_are_compacted(spark, folder, monkeypatch):
    monkeypatch.setattr("changefeed.streaming.jobs.COMPACT_EVERY", 3)
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    for k in range(6):
        capture_file(folder, f"{9 - k}.txt", k, 1, k)
        assert jobs.ingest_once(str(folder))["received"] == 1
    assert jobs.positions().count() == 6
    assert len(StateLog(spark, jobs.path("raw_log")).read()["positions"]) <= 3
    assert jobs.ingest_once(str(folder))["received"] == 0


def die_while_writing(spark, jobs, captures, monkeypatch, after_files):
    """A run whose driver stops: with files of the batch written but no end, or with the batch complete but not in place."""

    def write(path):
        def to(records):
            records.write.mode("overwrite").parquet(path)
            if after_files:
                os.remove(os.path.join(path.removeprefix("file:"), "_SUCCESS"))
            raise KeyboardInterrupt

        return to

    with monkeypatch.context() as patch:
        patch.setattr("changefeed.streaming.jobs.to_table", write)
        with pytest.raises(KeyboardInterrupt):
            jobs.ingest_once(str(captures))


@pytest.mark.parametrize("after_files", [True, False])
def test_readers_see_whole_batches_only(spark, folder, monkeypatch, after_files):
    """A batch dies while a clean stream runs over `raw`; no record comes twice."""
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    clean = lambda: finish(jobs.start_clean(files.raw_records(spark, jobs.path("raw"), stream=True)))
    capture_file(folder, "one.txt", 0, 4, 0)
    jobs.ingest_once(str(folder))
    clean()
    capture_file(folder, "two.txt", 4, 3, 1)
    die_while_writing(spark, jobs, folder, monkeypatch, after_files)
    clean()
    assert jobs.clean_edits(stream=False).count() == 4
    assert numbers(spark, jobs) == list(range(4))
    capture_file(folder, "three.txt", 7, 2, 2)
    again = Jobs(spark, jobs.root, Settings(bounded=True))
    again.ingest_once(str(folder))
    clean()
    assert numbers(spark, jobs) == list(range(9))
    edits = jobs.clean_edits(stream=False)
    assert edits.count() == 9 and edits.select("offset").distinct().count() == 9


def test_inner_blocks_are_not_shuffled(spark, folder):
    """Blocks inside a split go from the scan to the result without an exchange."""
    capture_file(folder, "one.txt", 0, 50, 0)
    blocks = capture.sse_blocks(capture.read_capture(spark, str(folder)))
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    inner = plan[plan.index("MapInArrow") - 2000 if plan.index("MapInArrow") > 2000 else 0 :]
    above = plan[: plan.index("MapInArrow")].split("Project")[-1]
    assert "Exchange hashpartitioning" not in inner.split("MapInArrow", 1)[1]
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in above
    assert blocks.count() == 50


def test_a_compressed_capture(spark, folder):
    import gzip

    text = "".join(f"id: {i}\r\ndata: x{i}\r\ndata: y\r\n\r\n" for i in range(2000)) + "data: open\r\n"
    (folder / "c.txt.gz").write_bytes(gzip.compress(text.encode()))
    events = capture.sse_events(capture.sse_blocks(capture.read_capture(spark, str(folder))))
    assert events.count() == 2000
    assert events.orderBy("block_no").first()["data"] == "x0\ny"
    assert events.agg(F.max("block_no")).first()[0] == 1999


def test_a_limited_run_reads_only_the_first_files(spark, folder, monkeypatch):
    """It goes on to more of them only while they hold too few events, and comes to the same as one read of all."""
    from changefeed.plans import ingest

    read = []

    def recorded(session, paths):
        read.append([os.path.basename(path) for path in paths])
        return read_capture(session, paths)

    read_capture = capture.read_capture
    monkeypatch.setattr(capture, "read_capture", recorded)
    monkeypatch.setattr(ingest.growing_starts, "__defaults__", (1,))
    monkeypatch.setattr(ingest, "GROWTH", 2)
    for part in range(12):  # names sort against the times; files 3 to 5 hold no event
        if 3 <= part <= 5:
            (folder / f"{99 - part}.txt").write_text(":ok\n\nid: x\n\n")
            os.utime(folder / f"{99 - part}.txt", (1700000000 + part, 1700000000 + part))
        else:
            capture_file(folder, f"{99 - part}.txt", 10 * part, 4, part)
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    assert jobs.ingest_once(str(folder), max_events=3)["received"] == 3
    assert read == [["99.txt"]] and jobs.resume_position() == "2"
    read.clear()
    assert jobs.ingest_once(str(folder), max_events=10)["received"] == 10
    assert read[0] == ["99.txt"] and len(read) > 1 and "88.txt" not in read[-1]
    first = [*range(4), *range(10, 14), *range(20, 24), 60]
    assert titles(spark, jobs) == [f"T{i}" for i in first]
    assert jobs.resume_position() == "60"
    read.clear()
    assert jobs.ingest_once(str(folder), max_events=1000)["received"] == 23
    assert len(read[-1]) == 6 and opened(spark, jobs, folder) == set()
    assert numbers(spark, jobs) == sorted(10 * part + i for part in (0, 1, 2, *range(6, 12)) for i in range(4))
    assert jobs.resume_position() == "113"


def test_a_batch_written_but_not_yet_measured_is_taken_back(spark, folder):
    capture_file(folder, "one.txt", 0, 5, 0)
    jobs = Jobs(spark, scratch_table(spark, "test"), NOW)
    unfinished, placed = jobs.path("raw/_unfinished/batch=000000000001"), jobs.path("raw/batch=000000000001")
    spark.range(1).write.parquet(unfinished)
    StateLog(spark, jobs.path("raw_log")).write({"pending": {"unfinished": unfinished, "folder": placed}})
    assert jobs.ingest_once(str(folder))["received"] == 5
    assert numbers(spark, jobs) == [0, 1, 2, 3, 4] and jobs.resume_position() == "4"
