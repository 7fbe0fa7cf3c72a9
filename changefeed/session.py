"""Session set-up and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()

# What a Python worker is handed at once. Spark's own limit is some 64 MB, of which a worker may hold several copies.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)

# State of several variables per key, such as a list with timers, is kept by RocksDB only.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # a batch stores what it has changed; whole snapshots follow in the background
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

STATIC_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    **STATE_CONF,
}


def build_session(app: str = "changefeed", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; cluster-wide sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of the session, once: functions that run there are found by its name.

    The archive is handed out by Spark's own file server, like the files of `--py-files`. Unless
    the session says otherwise, batches for Python are kept to BATCH_BYTES.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(BATCH_BYTES[0], str(BATCH_BYTES[1]))
    if context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="changefeed-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """A stream started meanwhile keeps its state in RocksDB, in whatever session; a stream takes its settings when it
    starts, and those of its checkpoint when it is started again."""
    before = {name: spark.conf.get(name, None) for name in STATE_CONF}
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Windows, wire timestamps and casts from zone-less input all assume UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` as named by the cluster, or
    the checkpoint folder the caller has set on the context.

    Only a local session may fall back to a temporary folder: there the driver and its
    executors share one machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="changefeed-")
        context.setCheckpointDir(folder)
    return folder


def session_folder(spark: SparkSession) -> str:
    """The session's own folder under the shared one; it goes when the driver ends."""
    context = spark.sparkContext
    folder = f"{shared_folder(spark).rstrip('/')}/changefeed-{context.applicationId}"
    place = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(place):
        files.mkdirs(place)
        files.deleteOnExit(place)
    return folder


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's own folder."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows stored in the session's own folder: they outlive any executor and are never computed twice."""
    path = scratch_table(df.sparkSession, "checkpoint")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
