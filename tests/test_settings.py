import subprocess
import sys
from pathlib import Path

import pytest

from changefeed import Settings, schemas
from changefeed.session import scratch_table, shared_folder
from changefeed.sources import kafka


def test_defaults():
    settings = Settings()
    assert (settings.out_of_order_seconds, settings.window_minutes, settings.war_seconds) == (15, 1, 600)
    assert settings.topic("raw") == "wiki.edits.raw"


@pytest.mark.parametrize("value", [0, -1, "1", 1.5, True, None])
def test_intervals_must_be_positive_whole_numbers(value):
    with pytest.raises(ValueError, match="window_minutes"):
        Settings(window_minutes=value)


def test_unknown_topic_is_rejected():
    with pytest.raises(ValueError, match="topics"):
        Settings(topics={"raw": "a"})


def test_environment_overrides():
    settings = Settings.from_env(
        {
            "CHANGEFEED_TOPIC_PREFIX": "test.",
            "CHANGEFEED_BOOTSTRAP_SERVERS": "broker:1",
            "CHANGEFEED_CAPTURES": "/captures",
            "CHANGEFEED_BOUNDED": "1",
        },
        window_minutes=5,
    )
    assert settings.topic("dlq") == "test.wiki.edits.dlq"
    assert settings.bootstrap_servers == "broker:1"
    assert settings.captures == "/captures"
    assert settings.bounded and settings.window_minutes == 5
    assert not Settings.from_env({}).bounded


def test_kafka_source_options():
    options = kafka.source_options(Settings(offsets_per_trigger=1000), "clean", group="stats")
    assert options["subscribe"] == "wiki.edits.clean"
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.isolation.level"] == "read_committed"
    assert options["kafka.group.id"] == "stats"
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert "endingOffsets" not in options


def test_kafka_bounded_source_stops_at_the_latest_offset():
    options = kafka.source_options(Settings(bounded=True), "raw")
    assert options["endingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in options


def test_kafka_sink_options():
    options = kafka.sink_options(Settings(), "alerts")
    assert options["topic"] == "wiki.alerts.edit_wars"
    assert options["kafka.acks"] == "all"
    assert options["kafka.enable.idempotence"] == "true"
    assert "topic" not in kafka.sink_options(Settings())


def test_records_of_a_key_stay_in_order(spark):
    records = spark.range(1000).selectExpr("concat('w', id % 7) as key", "999 - id as offset")
    tagged = kafka.in_key_order(records).selectExpr("*", "spark_partition_id() as task").collect()
    assert len({(row["key"], row["task"]) for row in tagged}) == 7
    for key in {row["key"] for row in tagged}:
        offsets = [row["offset"] for row in tagged if row["key"] == key]
        assert offsets == sorted(offsets)


def test_schema_helpers():
    assert schemas.names(schemas.EDIT_WAR)[:2] == ["wiki", "title"]
    assert schemas.names(schemas.RAW_EDIT)[0] == "meta"
    assert "wiki" not in schemas.without(schemas.CLEAN_EDIT, "wiki").split()


def test_shared_folder_is_read_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_table(spark, "x").startswith(shared_folder(spark))
    assert scratch_table(spark, "x") != scratch_table(spark, "x")


def test_nothing_is_left_in_the_shared_folder(tmp_path):
    """Intermediate tables and checkpoints go with the session."""
    root, shared = Path(__file__).resolve().parents[1], tmp_path / "shared"
    script = tmp_path / "run.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {str(root)!r})
from changefeed.session import build_session, checkpointed, scratch_table
spark = build_session(master="local[2]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(shared)!r}}})
spark.range(5).write.parquet(scratch_table(spark, "numbers"))
print("before", checkpointed(spark.range(5)).count())
spark.stop()
"""
    )
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300)
    assert "before 5" in done.stdout, done.stderr[-2000:]
    assert not [path for path in shared.rglob("*") if path.is_file()]
