"""Run a job: `spark-submit ... changefeed/__main__.py <job> --root <shared folder>`.

    ingest   captured feed files to raw records
    clean    raw records to clean edits and dead letters
    stats    clean edits to window statistics
    wars     clean edits to revert sequences
    judge    clean edits to a table of all of them, as on time or late for the statistics
    replay   clean, stats and wars once over all stored raw records, to tables under `replay`
    counts   records per topic after a replay
    tail     first rows of a stored table
    state    what the jobs hold, after which batch and watermark, and where a capture can go on

Ingest, clean, stats, wars and judge run as streams until stopped, for `--wait` seconds, or, with
`--bounded`, until what is stored has been handled. With `--kafka`, ingest writes to a topic, and
clean, stats and wars go from topic to topic; `--bounded` makes these batch runs up to the
present end.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from changefeed.operators import keyed
from changefeed.plans import topics
from changefeed.plans import replay as replaying
from changefeed.session import build_session
from changefeed.settings import Settings
from changefeed.sources import files, kafka
from changefeed.streaming.jobs import Jobs, finish, run_for

STREAMS = ("ingest", "clean", "stats", "wars", "judge")


def parse_args(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="changefeed", description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=[*STREAMS, "replay", "counts", "tail", "state"])
    parser.add_argument("--root", required=True, help="shared folder of tables and checkpoints")
    parser.add_argument("--captures", help="folder of captured feed files")
    parser.add_argument("--wikis", default="", help="only records of these wikis, names separated by commas")
    parser.add_argument("--max-events", type=int, help="append the next N captured events in one run")
    parser.add_argument("--wait", type=float, help="how many seconds a stream may run")
    parser.add_argument("--bounded", action="store_true", help="stop after what is stored now")
    parser.add_argument("--upserts", action="store_true", help="stats: early windows too, and every correction")
    parser.add_argument("--lossless", action="store_true", help="reject edits without a type too")
    parser.add_argument("--kafka", action="store_true", help="read and write topics instead of tables")
    parser.add_argument("--table", default="stats", help="table to tail: raw, edits, stats, wars or replay/...")
    parser.add_argument("--rows", type=int, default=5, help="rows to tail")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    settings = Settings.from_env()
    settings = replace(settings, bounded=settings.bounded or args.bounded)
    spark = build_session()
    jobs = Jobs(spark, args.root, settings)
    wikis = tuple(name for name in args.wikis.split(",") if name)
    captures = args.captures or settings.captures

    if args.job == "replay":
        raw = files.raw_records(spark, jobs.path("raw"))
        replaying.replay(raw, jobs.path("replay"), settings, args.lossless)
    elif args.job == "counts":
        raw = files.raw_records(spark, jobs.path("raw"))
        replaying.counts(spark, raw, jobs.path("replay"), settings).show(truncate=False)
    elif args.job == "state":
        jobs.held_state().show(truncate=False)
        print(f"{jobs.positions().count()} capture files taken, last event id {jobs.resume_position()}")
    elif args.job == "tail":
        rows = spark.read.parquet(jobs.path(args.table))
        order = next((name for name in ("offset", "window_start", "started_at") if name in rows.columns), rows.columns[0])
        keyed.tail(rows, args.rows, order).show(truncate=False)
    elif args.job == "ingest" and args.max_events is not None:
        print(jobs.ingest_once(captures, wikis, args.max_events, args.kafka))
    elif args.kafka and settings.bounded and args.job not in ("ingest", "judge"):
        records, stage = topic_records(spark, args, settings)
        kafka.write_records(records, settings, stage)
    else:
        query = start(spark, args, jobs, captures, wikis)
        run_for(query, args.wait) if args.wait else finish(query)
    return 0


def topic_records(spark: SparkSession, args: argparse.Namespace, settings: Settings):
    """Output records of a job over topics, and the stage they belong to (none: named in the records)."""
    if args.job == "clean":
        raw = kafka.read_topic(spark, settings, "raw", group="clean")
        return topics.clean_records(raw, settings, args.lossless), None
    clean = kafka.read_topic(spark, settings, "clean", group=args.job)
    if args.job == "stats":
        return topics.stats_records(clean, settings), "stats"
    return topics.war_records(clean, settings), "alerts"


def to_stats_topic(settings: Settings):
    return lambda rows: kafka.write_records(keyed.encode_upsert(rows), settings, "stats")


def start(
    spark: SparkSession, args: argparse.Namespace, jobs: Jobs, captures: str, wikis: tuple[str, ...]
) -> StreamingQuery:
    if args.job == "ingest":
        return jobs.start_ingest(captures, wikis, kafka=args.kafka)
    if args.job == "stats" and args.upserts:
        if not args.kafka:
            return jobs.start_stats_upserts(jobs.clean_edits())
        clean = keyed.decode_keyed(kafka.read_topic(spark, jobs.settings, "clean", group="stats"))
        return jobs.start_stats_upserts(clean, send=to_stats_topic(jobs.settings))
    if args.kafka and args.job == "judge":
        clean = keyed.decode_keyed(kafka.read_topic(spark, jobs.settings, "clean", group="judge"))
        return jobs.start_judged(clean)
    if args.kafka:
        records, stage = topic_records(spark, args, jobs.settings)
        return jobs.start_records(kafka.stream_records(records, jobs.settings, stage), args.job)
    if args.job == "clean":
        raw = files.raw_records(spark, jobs.path("raw"), stream=True, per_trigger=jobs.settings.bytes_per_trigger)
        return jobs.start_clean(raw, args.lossless)
    return {"stats": jobs.start_stats, "wars": jobs.start_wars, "judge": jobs.start_judged}[args.job](jobs.clean_edits())


if __name__ == "__main__":
    sys.exit(main())
