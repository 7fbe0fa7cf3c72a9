"""Start, restart and stop the streaming jobs.

Each job keeps its position and state in its own checkpoint under the root folder. Tables are
written through the file sink, whose commit log makes them exactly-once.
"""

from __future__ import annotations

import threading
import time
from collections import Counter, deque
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from changefeed.operators import clean as C
from changefeed.operators import stats
from changefeed.operators.keyed import latest_per_key
from changefeed.operators.routing import first_events
from changefeed.plans.ingest import (
    POSITION,
    file_places,
    growing_starts,
    new_positions,
    placed_blocks,
    store_raw,
    to_table,
    to_topic,
    unread_files,
)
from changefeed.session import checkpointed, ship_package, state_in_rocksdb
from changefeed.settings import Settings
from changefeed.sources import capture, files
from changefeed.sources.log import StateLog
from changefeed.streaming import state as held
from changefeed.streaming.wars import edit_wars_stream

COMPACT_EVERY = 50
DAY_SECONDS = 24 * 60 * 60
FILES_OF_DAY = 4
PART = "window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, wiki STRING, kind STRING, member STRING, " + ", ".join(
    f"{name} BIGINT" for name in stats.MEASURES
)


class Jobs:
    """The jobs over one root folder holding `raw`, `edits`, `stats`, `wars` and checkpoints.

    With `settings.bounded` a started query handles what is there and stops. The newest windows
    then stay open, as no later edit has closed them: a full replay is a batch run, see
    `changefeed.plans.replay`.
    """

    def __init__(self, spark: SparkSession, root: str, settings: Settings = Settings()) -> None:
        self.spark, self.root, self.settings = spark, root.rstrip("/"), settings
        self.ingested: Counter[str] = Counter()
        self.progress = Progress()
        self.hub = Hub.of(spark)
        ship_package(spark)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _start(self, writer: DataStreamWriter, job: str) -> StreamingQuery:
        writer = writer.queryName(job).option("checkpointLocation", self.path(f"_checkpoints/{job}"))
        every = {"processingTime": f"{self.settings.trigger_seconds} seconds"}
        query = writer.trigger(**({"availableNow": True} if self.settings.bounded else every)).start()
        self.hub.follow(str(query.id), self.progress)
        return query

    def _to_table(self, rows: DataFrame, table: str, *partitions: str) -> StreamingQuery:
        writer = rows.writeStream.format("parquet").outputMode("append").option("path", self.path(table))
        return self._start(writer.partitionBy(*partitions) if partitions else writer, table)

    def start_ingest(
        self, captures: str, wikis: tuple[str, ...] = (), files_per_trigger: int | None = None, kafka: bool = False
    ) -> StreamingQuery:
        """Capture files to raw records, in order of the files' modification times.

        `ingested` adds up what was received, produced and skipped, in events and characters, and
        the seconds it took. A batch that is run again after it was stored is left alone; records
        of a topic may come twice.
        """
        limit = ("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else (
            "maxBytesPerTrigger", self.settings.bytes_per_trigger
        )
        lines = self.spark.readStream.option(*limit).text(captures).select("value", "_metadata")

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            self._append(capture.place_lines(batch), wikis, kafka, batch_id=batch_id)

        return self._start(lines.writeStream.foreachBatch(write_batch), "ingest")

    def ingest_once(
        self, captures: str, wikis: tuple[str, ...] = (), max_events: int | None = None, kafka: bool = False
    ) -> dict[str, float]:
        """Append what has been captured and not been taken yet, or its first `max_events` events.

        Files are taken in the order of their modification times, those of one time by name. Only files
        that are new or have grown since are opened, whatever their names, and with `max_events` only so
        many of the first of them as hold these events.
        """
        before = Counter(self.ingested)
        unread = unread_files(self.spark, captures, self.positions())
        for paths in growing_starts(unread) if max_events is not None else [[*unread]] if unread else []:
            lines = capture.read_capture(self.spark, paths)
            if self._append(lines, wikis, kafka, max_events=max_events, enough=len(paths) < len(unread)):
                break
        return {name: self.ingested[name] - before[name] for name in before | self.ingested}

    def positions(self) -> DataFrame:
        """(file, size, modified, blocks, whole, number): how many blocks have been taken of every capture file, and in
        which batch; `whole` if all that it held at this size."""
        return self._positions(self._ingest_state(self._ingest_log())["positions"])

    def _positions(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], POSITION)
        return latest_per_key(self.spark.read.schema(POSITION).parquet(*folders), ("file",), "number")

    def resume_position(self) -> str | None:
        """The id after which a capture of the feed can go on: the last one stored, by the files' times."""
        return self._ingest_state(self._ingest_log())["last_event_id"]

    def _ingest_log(self) -> StateLog:
        return StateLog(self.spark, self.path("raw_log"))

    def _append(
        self,
        lines: DataFrame,
        wikis: tuple[str, ...],
        kafka: bool,
        batch_id: int | None = None,
        max_events: int | None = None,
        enough: bool = False,
    ) -> bool:
        """One batch of captured lines to a folder of its own: announced, written, moved into place, and then counted.

        The state holds the next offset, the last batch of the stream, the folders that tell what has
        been taken of each file, and the feed's own last event id with its place. A folder is written
        where readers of `raw` do not look and renamed when it is complete, so they see whole batches.
        With `enough`, nothing is done and the answer is no if the lines hold fewer than `max_events` events.
        """
        began = time.monotonic()
        log = self._ingest_log()
        state = self._ingest_state(log)
        if batch_id is not None and batch_id <= state["batch"]:
            return True
        number = state["number"] + 1
        ends = capture.split_ends(lines)
        files_read = checkpointed(file_places(ends, self._positions(state["positions"])))
        blocks = placed_blocks(capture.sse_blocks(lines, ends), files_read, state["next_offset"])
        last = None
        if max_events is not None:
            # the lines are read once for the narrow places of the events, in which the last one is then looked up
            places = checkpointed(capture.sse_events(blocks).select("offset", "modified", "file", "block_no"))
            place = F.struct("offset", "modified", "file", "block_no")
            last = first_events(places, max_events).agg(F.count("*").alias("n"), F.max(place).alias("last")).first()
            if enough and last["n"] < max_events:
                return False
            # fewer events than asked for: all blocks are taken, those without an event too
            last = last["last"] if last["n"] >= max_events else None
            if last is not None:
                blocks = blocks.where(F.col("offset") <= last["offset"])
        total = files_read.agg(F.sum(F.greatest(F.col("blanks") - F.col("taken"), F.lit(0))).alias("n")).first()["n"] or 0
        positions = self.path(f"raw_positions/batch={number:012d}")
        taken = new_positions(files_read, number, last and tuple(last)[1:])
        folders = [*state["positions"], positions]
        if len(folders) > COMPACT_EVERY:
            older = self._positions(state["positions"])
            taken, folders = older.join(taken, "file", "left_anti").unionByName(taken), [positions]
        taken.write.mode("overwrite").parquet(positions)
        unfinished, folder = (self.path(f"raw/{place}batch={number:012d}") for place in ("_unfinished/", ""))
        if not kafka:
            log.write(state | {"pending": {"unfinished": unfinished, "folder": folder}})
        # the newest id is seen while the events are written; that of a block without an event counts too
        newest = Observation()
        at = F.when(F.col("id") != "", F.col("offset"))
        modified = F.date_format("modified", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        place = {"modified": modified, "file": F.col("file"), "block_no": F.col("block_no"), "id": F.col("id")}
        blocks = blocks.observe(newest, *[F.max_by(value, at).alias(name) for name, value in place.items()])
        events = capture.sse_events(blocks)
        counted = store_raw(events, to_topic(self.settings) if kafka else to_table(unfinished), wikis)
        seen = newest.get
        id_place = [seen.get(name) for name in ("modified", "file", "block_no")]
        after_it = state | {
            "number": number,
            "next_offset": last["offset"] + 1 if last is not None else state["next_offset"] + total,
            "positions": folders,
            **({"batch": batch_id} if batch_id is not None else {}),
        }
        if seen.get("id") is not None and (state["id_place"] or []) < id_place:
            after_it |= {"id_place": id_place, "last_event_id": seen["id"]}
        self.ingested.update(counted)
        if not kafka:
            log.write(state | {"pending": {"unfinished": unfinished, "folder": folder, "state": after_it}})
            log.move(unfinished, folder)
        log.write(after_it)
        self.ingested.update({"seconds": time.monotonic() - began})
        return True

    def _ingest_state(self, log: StateLog) -> dict:
        """The state of ingest. A batch that was announced counts once its folder is complete and it is known what
        holds after it, and is else taken back."""
        state = {"number": 0, "next_offset": 0, "batch": -1, "positions": []}
        state |= {"id_place": None, "last_event_id": None} | log.read()
        pending = state.pop("pending", None)
        if pending:
            folder, unfinished = pending["folder"], pending.get("unfinished", pending["folder"])
            if "state" in pending and not log.complete(folder) and log.complete(unfinished):
                log.move(unfinished, folder)
            if "state" in pending and log.complete(folder):
                state = pending["state"]
            else:
                log.remove(unfinished)
            log.write(state)
        return state

    def ingest_rate(self) -> float:
        """Events received per second of work."""
        return self.ingested["received"] / self.ingested["seconds"] if self.ingested["seconds"] else 0.0

    def start_clean(self, raw: DataFrame, lossless: bool = False) -> StreamingQuery:
        """Raw records to both outlets, committed together."""
        return self._to_table(C.split_raw(raw, lossless).drop("key"), "edits", "outlet")

    def clean_edits(self, stream: bool = True) -> DataFrame:
        limit = self.settings.bytes_per_trigger
        return C.clean_of(files.split_edits_table(self.spark, self.path("edits"), stream, limit))

    def start_stats(self, clean: DataFrame) -> StreamingQuery:
        """Final windows, each written once."""
        rows = stats.wiki_stats(clean, self.settings.window_minutes, self.settings.out_of_order_seconds)
        return self._to_table(rows, "stats")

    def start_judged(self, clean: DataFrame) -> StreamingQuery:
        """Every edit to the table `judged`, as `on_time`, `late`, or `untimed` if it has no time: none is lost.

        The rule is that of the statistics stream over the same increments: an edit is late if its window
        ended at or before the watermark, and the watermark of a batch is the latest event time of the batches before
        it, less the delay. It is kept in a log, so it is the same after a restart, and moves only once a
        batch is in place.
        """
        # by numbers, as the window function leaves rows without a time out
        width = 60_000 * self.settings.window_minutes
        window_end = (F.floor(F.unix_millis("event_time") / width) + 1) * width

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            log = StateLog(self.spark, self.path("judged_log"))
            state = {"last": -1, "newest_ms": None} | log.read()
            if batch_id <= state["last"]:
                return
            watermark = None if state["newest_ms"] is None else state["newest_ms"] - 1000 * self.settings.out_of_order_seconds
            late = window_end <= F.lit(watermark).cast("bigint")
            outlet = F.when(F.col("event_time").isNull(), "untimed").when(F.coalesce(late, F.lit(False)), "late").otherwise("on_time")
            judged = batch.withColumn("outlet", outlet)
            newest = F.max(F.unix_millis("event_time")).alias("newest")
            unfinished, folder = (self.path(f"judged/{place}batch={batch_id:012d}") for place in ("_unfinished/", ""))
            if log.complete(folder):  # stored by a run that ended before it was counted
                seen = batch.agg(newest).first().asDict()
            else:
                counts = Observation()
                judged.observe(counts, newest).write.mode("overwrite").partitionBy("outlet").parquet(unfinished)
                log.move(unfinished, folder)
                seen = counts.get
            known = [ms for ms in (state["newest_ms"], seen["newest"]) if ms is not None]
            log.write({"last": batch_id, "newest_ms": max(known, default=None)})

        return self._start(clean.writeStream.foreachBatch(write_batch), "judged")

    def judged(self, schema: str | StructType) -> DataFrame:
        """What `start_judged` has stored so far: the edits with their `outlet`; a filter on it reads only those files."""
        kept = StructType([*(StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields])
        return self.spark.read.schema(kept.add("batch", "long").add("outlet", "string")).parquet(self.path("judged"))

    def held_state(self) -> DataFrame:
        """What every job of this root holds: see `changefeed.streaming.state.report`."""
        log = StateLog(self.spark, self.path("raw_log"))
        folder = self.path("_checkpoints")
        jobs = sorted(name for name in log.children(folder) if "state" in log.children(f"{folder}/{name}"))
        reports = [held.report(self.spark, f"{folder}/{job}", job) for job in jobs]
        return reduce(DataFrame.unionByName, reports, self.spark.createDataFrame([], held.REPORT))

    def start_wars(self, clean: DataFrame) -> StreamingQuery:
        rows = edit_wars_stream(clean, self.settings.war_seconds, self.settings.out_of_order_seconds)
        with state_in_rocksdb(self.spark):
            return self._to_table(rows, "wars")

    def start_records(self, writer: DataStreamWriter, job: str) -> StreamingQuery:
        """Any writer of records, such as one to a topic, under this root's checkpoints."""
        with state_in_rocksdb(self.spark):  # they may be those of revert sequences
            return self._start(writer, f"{job}_records")

    def start_stats_upserts(
        self,
        clean: DataFrame,
        compact_every: int = COMPACT_EVERY,
        send: Callable[[DataFrame], None] | None = None,
    ) -> StreamingQuery:
        """Early windows, corrected as edits come in: each batch writes the parts it changed.

        Parts lie in folders by the day of their window, and the log names those of each day. `send`
        gets the whole rows of the windows a batch has changed, at least once, to write them to a
        topic for example; for this only the days it has changed are read. Every so many changes of a
        day the newest version of its parts is written together. Once no window of a day can change
        any more, this is done a last time, and then the day is never touched again.
        """
        parts = stats.window_parts(clean, self.settings.window_minutes, self.settings.out_of_order_seconds)
        parts = parts.withColumn("day", F.floor(F.unix_seconds("window.start") / DAY_SECONDS).cast("int"))

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            log = StateLog(self.spark, self.path("stats_log"))
            state = self._parts_state(log)
            if batch_id <= state["last"]:
                return
            folder = self.path(f"stats_parts/batch={batch_id:08d}")
            by_day(batch.withColumn("batch", F.lit(batch_id))).write.mode("overwrite").partitionBy("day").parquet(folder)
            changed = [name.partition("=")[2] for name in log.children(folder) if name.startswith("day=")]
            if not changed:
                log.remove(folder)
            state["last"] = batch_id
            for day in changed:
                known = state["days"].setdefault(day, {"folders": []})
                known["folders"].append(folder)
                known["last"] = batch_id
            if send is not None and changed:
                send(self._changed_stats({day: state["days"][day] for day in changed}, batch_id - 1))
            self._compact(log, state, changed, compact_every)
            log.write(state)

        return self._start(parts.writeStream.outputMode("update").foreachBatch(write_batch), "stats_upserts")

    def _parts_state(self, log: StateLog) -> dict:
        """Days with the folders that hold their parts and the last batch that changed them; folders no longer in use."""
        return {"days": {}, "stale": [], "last": -1} | log.read()

    def _compact(self, log: StateLog, state: dict, changed: list[str], compact_every: int) -> None:
        """Put the parts of days together that have been changed often or are over.

        A day is over once a later day but one has parts. What is replaced goes with the next call, so a
        reader that has just read the log still finds it.
        """
        over = max(map(int, state["days"]), default=0) - 1
        due = [
            day
            for day, known in state["days"].items()
            if len(known["folders"]) >= (max(2, compact_every) if day in changed or int(day) >= over else 2)
        ]
        if not due:
            return
        for old in state["stale"]:
            log.remove(old)
        for parent in {old.rpartition("/")[0] for old in state["stale"]}:
            if not any(name.startswith("day=") for name in log.children(parent)):
                log.remove(parent)
        table = self.path(f"stats_parts/upto={state['last']:08d}")
        newest = self._newest_parts({day: state["days"][day] for day in due})
        day = F.floor(F.unix_seconds("window.start") / DAY_SECONDS).cast("int")
        by_day(newest.withColumn("day", day)).write.mode("overwrite").partitionBy("day").parquet(table)
        state["stale"] = [f"{folder}/day={day}" for day in due for folder in state["days"][day]["folders"]]
        for day in due:
            state["days"][day]["folders"] = [table]

    def _newest_parts(self, days: dict) -> DataFrame:
        """The newest version of every part of these days."""
        paths = [f"{folder}/day={day}" for day, known in days.items() for folder in known["folders"]]
        schema = f"{PART}, batch INT"
        parts = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return latest_per_key(parts, keys=("window", "wiki", "kind", "member"), order="batch")

    def corrected_stats(self) -> DataFrame:
        """Statistics from the newest version of every part."""
        state = self._parts_state(StateLog(self.spark, self.path("stats_log")))
        return stats.roll_up(self._newest_parts(state["days"]).drop("batch"))

    def changed_stats(self, since: int) -> DataFrame:
        """Whole rows of the windows that batches after `since` have changed: the corrections to send on."""
        days = self._parts_state(StateLog(self.spark, self.path("stats_log")))["days"]
        return self._changed_stats({day: known for day, known in days.items() if known["last"] > since}, since)

    def _changed_stats(self, days: dict, since: int) -> DataFrame:
        parts = self._newest_parts(days)
        changed = parts.where(F.col("batch") > since).select("window", "wiki").distinct()
        same = [parts[name].eqNullSafe(changed[name]) for name in ("window", "wiki")]
        return stats.roll_up(parts.join(changed, same, "left_semi").drop("batch"))


def by_day(parts: DataFrame) -> DataFrame:
    """The parts with those of a day in a few tasks, so that a day gets a few files however many tasks and days there are."""
    return parts.repartition("day", F.pmod(F.xxhash64("wiki", "kind", "member"), F.lit(FILES_OF_DAY)))


class Progress:
    """Adds up, per job, the rows read and those that came too late for the watermark."""

    def __init__(self) -> None:
        self.late: Counter[str] = Counter()
        self.rows: Counter[str] = Counter()
        self.rate: dict[str, float] = {}

    def add(self, progress) -> None:
        self.late[progress.name] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        self.rows[progress.name] += progress.numInputRows
        self.rate[progress.name] = progress.inputRowsPerSecond


class Hub(StreamingQueryListener):
    """The one listener of a session, however many `Jobs` it has: gives each query's progress to those that started it."""

    _hubs: dict[str, Hub] = {}

    def __init__(self) -> None:
        self.lock = threading.Lock()
        self.followed: dict[str, Progress] = {}
        self.early: dict[str, deque] = {}  # of queries not followed yet

    @classmethod
    def of(cls, spark: SparkSession) -> Hub:
        application = spark.sparkContext.applicationId
        if application not in cls._hubs:
            cls._hubs[application] = cls()
            spark.streams.addListener(cls._hubs[application])
        return cls._hubs[application]

    def follow(self, query_id: str, progress: Progress) -> None:
        with self.lock:
            self.followed[query_id] = progress
            for seen in self.early.pop(query_id, ()):
                progress.add(seen)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        query_id = str(event.progress.id)
        with self.lock:
            if query_id in self.followed:
                self.followed[query_id].add(event.progress)
            else:
                self.early.setdefault(query_id, deque(maxlen=50)).append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            # a bounded query may end before it is followed; of others' queries no more than these few are kept
            while len(self.early) > 100:
                self.early.pop(next(iter(self.early)))


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Let a query run for a while, then stop it."""
    query.awaitTermination(seconds)
    query.stop()


def finish(query: StreamingQuery) -> None:
    """Wait for a bounded query."""
    query.awaitTermination()
