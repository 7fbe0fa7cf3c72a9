"""One function per operator: (spark, folder of test tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.operators import clean as C
from changefeed.operators import keyed, late, order, routing, stats, wars
from changefeed.plans import replay
from changefeed.session import checkpointed, pin_utc, scratch_table
from changefeed.settings import Settings
from changefeed.sources import capture, files
from changefeed.streaming.jobs import Jobs, finish
from checks import feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TWO_DAYS = 2 * 24 * 60 * 60
FAR_FUTURE = "timestamp '2100-01-01 00:00:00'"


def query(build: Query) -> Query:
    """Register under the function's name; instants come out as zone-less UTC, like the tables' own."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = build(pin_utc(spark), sf_dir)
        instants = [name for name, kind in rows.dtypes if kind == "timestamp"]
        return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})

    QUERIES[build.__name__] = run
    return run


def clean_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_edits(feed.raw_edits(spark, sf_dir))


def split_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.split_raw(feed.raw_edits(spark, sf_dir))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.raw_edits(spark, sf_dir).withColumnRenamed("value", "data")


def captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of the feed after writing it as capture files and reading them back."""
    folder = scratch_table(spark, "captures")
    feed.capture_lines(feed.raw_edits(spark, sf_dir)).write.text(folder)
    return capture.sse_blocks(capture.read_capture(spark, folder))


# -- sources, decoding, ingest -----------------------------------------------------------


@query
def raw_scan(spark, sf_dir):
    folder = scratch_table(spark, "raw")
    feed.raw_edits(spark, sf_dir).write.parquet(folder)
    return files.raw_records(spark, folder).select("offset", "value")


@query
def parse_raw(spark, sf_dir):
    parsed = C.parse_raw(feed.raw_edits(spark, sf_dir))
    return parsed.select(
        "offset",
        F.col("meta.domain").alias("domain"),
        "id",
        "type",
        "namespace",
        "title",
        "comment",
        "timestamp",
        "user",
        "bot",
        "minor",
        "patrolled",
        F.col("length.old").alias("old_length"),
        F.col("length.new").alias("new_length"),
        F.col("revision.new").alias("revision_id"),
        "server_name",
        "wiki",
        "event_time",
    )


@query
def sse_events(spark, sf_dir):
    return capture.sse_events(captured(spark, sf_dir)).select("event", "data", "id", "retry_ms")


@query
def resume_position(spark, sf_dir):
    return capture.resume_position(captured(spark, sf_dir))


@query
def route_raw(spark, sf_dir):
    return routing.route_raw(payloads(spark, sf_dir))


@query
def route_raw_filtered(spark, sf_dir):
    return routing.route_raw(payloads(spark, sf_dir), ("click", "error.example.org"))


@query
def route_raw_limited(spark, sf_dir):
    return routing.route_raw(routing.first_events(payloads(spark, sf_dir), 1000))


@query
def ingest_appends(spark, sf_dir):
    """Two single runs and a stream, one after another, over the same capture files."""
    folder = scratch_table(spark, "captures")
    feed.capture_lines(feed.raw_edits(spark, sf_dir)).write.text(folder)
    jobs = Jobs(spark, scratch_table(spark, "ingest"), Settings(bounded=True))
    jobs.ingest_once(folder, max_events=70)
    jobs.ingest_once(folder, max_events=30)
    finish(jobs.start_ingest(folder))
    return files.raw_records(spark, jobs.path("raw")).select("key", "value")


@query
def ingest_metrics(spark, sf_dir):
    return routing.ingest_metrics(payloads(spark, sf_dir))


# -- validation ----------------------------------------------------------------------------


@query
def clean_edits(spark, sf_dir):
    return clean_feed(spark, sf_dir).drop("offset")


@query
def dlq_edits(spark, sf_dir):
    return C.dlq_edits(feed.raw_edits(spark, sf_dir)).drop("rejected_at")


@query
def dlq_edits_lossless(spark, sf_dir):
    return C.dlq_edits(feed.raw_edits(spark, sf_dir), lossless=True).drop("rejected_at")


@query
def dlq_reasons(spark, sf_dir):
    rejected = C.dlq_edits(feed.raw_edits(spark, sf_dir))
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("records"))


@query
def fan_out(spark, sf_dir):
    return split_feed(spark, sf_dir).select("outlet", "offset", "reject_reason", "wiki", "title")


@query
def fan_out_records(spark, sf_dir):
    """Both outlets as records with their topic; the time of rejection is taken out."""
    settings = Settings()
    records = keyed.encode_split(split_feed(spark, sf_dir), settings.topic("clean"), settings.topic("dlq"))
    return records.withColumn("value", F.regexp_replace("value", ',"rejected_at":"[^"]+Z"', ""))


# -- statistics ----------------------------------------------------------------------------


@query
def wiki_stats(spark, sf_dir):
    return stats.wiki_stats(clean_feed(spark, sf_dir))


@query
def wiki_stats_5m(spark, sf_dir):
    return stats.wiki_stats(clean_feed(spark, sf_dir), window_minutes=5)


@query
def wiki_stats_1d(spark, sf_dir):
    return stats.wiki_stats(clean_feed(spark, sf_dir), window_minutes=1440)


@query
def wiki_stats_approx(spark, sf_dir):
    return stats.wiki_stats(clean_feed(spark, sf_dir), window_minutes=1440, approx=True)


@query
def wiki_stats_widened(spark, sf_dir):
    """Days from a stored table of minutes with sketches; the edits are not read again."""
    folder = scratch_table(spark, "minutes")
    stats.sketched_stats(clean_feed(spark, sf_dir)).write.parquet(folder)
    return stats.estimated(stats.widen(stats.widen(spark.read.parquet(folder), 60), 1440))


@query
def late_edits(spark, sf_dir):
    arrivals = feed.shuffled_arrivals(clean_feed(spark, sf_dir))
    return late.late_edits(arrivals).select(
        "partition", "offset", "wiki", "title", "user", "revision_id", "event_time", "window_end", "watermark"
    )


# -- revert sequences ----------------------------------------------------------------------


@query
def edit_wars(spark, sf_dir):
    return wars.edit_wars(clean_feed(spark, sf_dir), TWO_DAYS)


@query
def edit_wars_10m(spark, sf_dir):
    return wars.edit_wars(feed.dense_edits(spark, sf_dir))


@query
def edit_wars_sliced(spark, sf_dir):
    """Every busy page taken as too large for one task."""
    return wars.edit_wars(feed.dense_edits(spark, sf_dir), hot_page_edits=90, slice_edits=40)


# -- keyed records -------------------------------------------------------------------------


@query
def encode_keyed(spark, sf_dir):
    return keyed.encode_keyed(clean_feed(spark, sf_dir)).drop("offset")


@query
def sequenced_records(spark, sf_dir):
    """Keyed records with their number within the wiki, dealt over tasks by ranges."""
    return order.sequenced(keyed.encode_keyed(clean_feed(spark, sf_dir)), parts=8).drop("part")


@query
def sequence_gaps(spark, sf_dir):
    """What a reader finds when every hundredth record is lost and every fiftieth comes twice."""
    sent = order.sequenced(keyed.encode_keyed(clean_feed(spark, sf_dir)), parts=8).drop("part", "value")
    kept = sent.where(F.col("offset") % 100 != 0)
    return order.out_of_order(kept.unionByName(kept.where(F.col("offset") % 50 == 1)))


@query
def decode_keyed(spark, sf_dir):
    return keyed.decode_keyed(keyed.encode_keyed(clean_feed(spark, sf_dir))).drop("offset")


@query
def encode_upsert(spark, sf_dir):
    return keyed.encode_upsert(stats.wiki_stats(clean_feed(spark, sf_dir)))


@query
def latest_upserts(spark, sf_dir):
    """What a compacted topic keeps of early windows and their corrections."""
    clean = clean_feed(spark, sf_dir)
    early = keyed.encode_upsert(stats.wiki_stats(halves(clean)[0])).withColumn("offset", F.lit(0))
    final = keyed.encode_upsert(stats.wiki_stats(clean)).withColumn("offset", F.lit(1))
    return keyed.latest_per_key(early.unionByName(final)).select("key", "value")


@query
def encode_dlq(spark, sf_dir):
    return keyed.encode_append(C.dlq_edits(feed.raw_edits(spark, sf_dir)).drop("rejected_at"))


@query
def encode_alerts(spark, sf_dir):
    return keyed.encode_append(wars.edit_wars(feed.dense_edits(spark, sf_dir)))


@query
def latest_per_key(spark, sf_dir):
    return keyed.latest_per_key(keyed.encode_keyed(clean_feed(spark, sf_dir)))


@query
def tail(spark, sf_dir):
    return keyed.tail(keyed.encode_keyed(clean_feed(spark, sf_dir)), 5)


# -- whole runs ----------------------------------------------------------------------------


def replayed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    raw, root = feed.raw_edits(spark, sf_dir), scratch_table(spark, "replay")
    replay.replay(raw, root, Settings(war_seconds=TWO_DAYS))
    return raw, root


@query
def replay_stats(spark, sf_dir):
    _, root = replayed(spark, sf_dir)
    return spark.read.parquet(f"{root}/stats")


@query
def replay_wars(spark, sf_dir):
    _, root = replayed(spark, sf_dir)
    return spark.read.parquet(f"{root}/wars")


@query
def topic_counts(spark, sf_dir):
    raw, root = replayed(spark, sf_dir)
    return replay.counts(spark, raw, root)


def halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with earlier offsets, and those with later ones; the rows are worked out once and stored."""
    rows = checkpointed(rows)
    middle = rows.agg((F.max("offset") / 2).alias("middle")).first()["middle"]
    return rows.where(F.col("offset") <= middle), rows.where(F.col("offset") > middle)


def streamed(spark: SparkSession, edits: DataFrame, settings: Settings, start: Callable[[Jobs, DataFrame], object]) -> Jobs:
    """Run a job over clean edits stored in two steps, restarting it in between.

    With the second step comes an edit from the far future, which closes all windows.
    """
    jobs = Jobs(spark, scratch_table(spark, "stream"), settings)
    folder = jobs.path("input")
    closer = spark.range(1).select(
        F.lit("closer").alias("wiki"), F.lit("closer").alias("title"), F.expr(FAR_FUTURE).alias("event_time")
    )
    first, second = halves(edits)
    for part in (first, second.unionByName(closer, allowMissingColumns=True)):
        part.write.mode("append").parquet(folder)
        finish(start(jobs, files.read_table(spark, folder, edits.schema, stream=True)))
    return jobs


@query
def stream_clean(spark, sf_dir):
    """The clean job over two increments; both outlets read back from its table."""
    jobs = Jobs(spark, scratch_table(spark, "stream"), Settings(bounded=True))
    folder = jobs.path("raw")
    raw = feed.raw_edits(spark, sf_dir).withColumn("key", F.lit(None).cast("string"))
    for part in halves(raw):
        part.write.mode("append").parquet(folder)
        finish(jobs.start_clean(files.raw_records(spark, folder, stream=True)))
    split = files.split_edits_table(spark, jobs.path("edits"))
    return split.select("outlet", "offset", "reject_reason", "wiki", "title")


@query
def stream_stats(spark, sf_dir):
    jobs = streamed(spark, clean_feed(spark, sf_dir), Settings(bounded=True), Jobs.start_stats)
    return spark.read.parquet(jobs.path("stats"))


@query
def stream_stats_upserts(spark, sf_dir):
    jobs = streamed(
        spark, clean_feed(spark, sf_dir), Settings(bounded=True, window_minutes=1440), Jobs.start_stats_upserts
    )
    return jobs.corrected_stats().where("wiki <> 'closer'")


@query
def stream_wars(spark, sf_dir):
    jobs = streamed(spark, feed.dense_edits(spark, sf_dir), Settings(bounded=True), Jobs.start_wars)
    return spark.read.parquet(jobs.path("wars"))


@query
def stream_late(spark, sf_dir):
    """On time or late, over two increments; both outlets read back, and nothing lost between them."""
    clean = clean_feed(spark, sf_dir)
    jobs = Jobs(spark, scratch_table(spark, "stream"), Settings(bounded=True))
    folder = jobs.path("input")
    for part in halves(clean):
        part.write.mode("append").parquet(folder)
        finish(jobs.start_judged(files.read_table(spark, folder, clean.schema, stream=True)))
    return jobs.judged(clean.schema).select("outlet", "offset", "wiki", "event_time")


@query
def stream_state(spark, sf_dir):
    """What the statistics job holds when its input pauses, read from its checkpoint."""
    clean = clean_feed(spark, sf_dir)
    jobs = Jobs(spark, scratch_table(spark, "stream"), Settings(bounded=True, window_minutes=1440))
    folder = jobs.path("input")
    for part in halves(clean):
        part.write.mode("append").parquet(folder)
        finish(jobs.start_stats(files.read_table(spark, folder, clean.schema, stream=True)))
    return jobs.held_state().select("job", "operator", "rows", "watermark")
