from __future__ import annotations

import pytest

from changefeed.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="changefeed-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EDITS = "wiki string, title string, user string, is_bot boolean, byte_delta int, type string, second bigint, offset bigint"


@pytest.fixture
def edits(spark):
    """Clean edits from (wiki, title, user, is_bot, byte_delta, type, second, offset) tuples."""
    from pyspark.sql import functions as F

    def build(rows):
        df = spark.createDataFrame(rows, EDITS)
        return df.withColumn("event_time", F.timestamp_seconds("second")).drop("second")

    return build
