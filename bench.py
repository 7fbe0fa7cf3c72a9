"""Time the headline queries; prints one JSON line.

The raw feed and its clean edits are first stored as tables, as the jobs would find them, so
each figure covers one job from its stored input to its last row.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from changefeed.operators import clean as C
from changefeed.operators import keyed, routing, stats, wars
from changefeed.operators.late import late_edits
from changefeed.plans import replay
from changefeed.session import build_session, scratch_table
from changefeed.settings import Settings
from changefeed.sources import capture
from checks import feed
from checks.queries import TWO_DAYS

RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    root = scratch_table(spark, "bench")
    feed.raw_edits(spark, sf_dir).repartition(int(cpus)).write.parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    feed.capture_lines(raw).write.text(f"{root}/captures")
    replay.replay_clean(raw, f"{root}/replayed")
    clean = replay.clean_table(spark, f"{root}/replayed")
    feed.dense_edits(spark, sf_dir).repartition(int(cpus)).write.parquet(f"{root}/dense")
    dense = spark.read.parquet(f"{root}/dense")
    payloads = raw.withColumnRenamed("value", "data")

    queries = {
        "sse_events": lambda: capture.sse_events(capture.sse_blocks(capture.read_capture(spark, f"{root}/captures"))),
        "route_raw": lambda: routing.route_raw(payloads),
        "ingest_metrics": lambda: routing.ingest_metrics(payloads),
        "clean_edits": lambda: C.clean_edits(raw),
        "fan_out": lambda: C.split_raw(raw),
        "encode_keyed": lambda: keyed.encode_keyed(clean),
        "decode_keyed": lambda: keyed.decode_keyed(keyed.encode_keyed(clean)),
        "wiki_stats": lambda: stats.wiki_stats(clean),
        "wiki_stats_1d": lambda: stats.wiki_stats(clean, 1440),
        "late_edits": lambda: late_edits(feed.shuffled_arrivals(clean)),
        "edit_wars": lambda: wars.edit_wars(clean, TWO_DAYS),
        "edit_wars_10m": lambda: wars.edit_wars(dense),
        "latest_per_key": lambda: keyed.latest_per_key(keyed.encode_keyed(clean)),
    }
    seconds = {}
    for name, build in queries.items():
        seconds[name] = best_of(lambda: build().write.format("noop").mode("overwrite").save())
    settings = Settings(war_seconds=TWO_DAYS)
    seconds["replay"] = best_of(lambda: replay.replay(raw, f"{root}/replayed", settings))

    n_events = raw.count()
    scale = re.search(r"sf([0-9.]+)/?$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries, best of 3 runs each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "events": n_events,
                "events_per_second": {name: round(n_events / took) for name, took in seconds.items()},
                "cpus": int(cpus),
            }
        )
    )


def best_of(run) -> float:
    took = []
    for _ in range(RUNS):
        started = time.perf_counter()
        run()
        took.append(time.perf_counter() - started)
    return round(min(took), 3)


if __name__ == "__main__":
    main()
