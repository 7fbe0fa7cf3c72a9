"""The two increments of the streamed queries."""

from checks.queries import halves


def test_rows_of_both_halves_are_worked_out_once(spark):
    worked = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            worked.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(i, f"r{i}") for i in (*range(10), 9)] + [(None, "none")], "offset bigint, name string")
    parts = halves(rows.mapInPandas(count, rows.schema))
    assert [sorted(row["offset"] for row in part.collect()) for part in parts] == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9, 9]]
    assert worked.value == 12


def test_a_day_gets_few_files_however_many_tasks(spark, edits):
    """A batch's parts of a day lie in a few files, not in one per task of the state."""
    from changefeed.operators import stats
    from changefeed.sources.log import StateLog
    from changefeed.streaming.jobs import Jobs
    from tests.test_streaming import T0, Feed, same

    rows = [("w", f"P{i}", f"u{i}", False, 1, "edit", T0 + 86400 * (i % 3), i) for i in range(150)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        feed = Feed(spark, edits, Jobs.start_stats_upserts)
        feed.add(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert same(feed.jobs.corrected_stats(), stats.wiki_stats(edits(rows)))
    log = StateLog(spark, feed.jobs.path("stats_log"))
    days = [f"{folder}/day={day}" for day, known in log.read()["days"].items() for folder in known["folders"]]
    files = [len([name for name in log.children(folder) if name.endswith(".parquet")]) for folder in days]
    assert len(days) >= 3 and 1 <= min(files) and max(files) <= 4
