"""Revert sequences on a stream: the same rule as the bounded operator, kept as state per page.

A page's state is a list of waiting edits, to which new ones are only appended, and a note of how far it has
been worked off. An edit is looked at once the watermark has passed it and its successors, when a timer fires,
so a match is reported then and not when the page falls silent. What has been worked off is left in
the list until it is half of it; only then is the list written anew. So what a batch writes
follows its new edits, not those that wait.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from changefeed import schemas
from changefeed.functions import edits as E
from changefeed.operators.wars import PAGE
from changefeed.settings import check_positive

# The worker that prepares the operator beside the driver has no files sent to executors: what runs there goes as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WAITING = "micros BIGINT, offset BIGINT, user STRING, person BOOLEAN, byte_delta STRING"
EDIT = tuple(column.split()[0] for column in WAITING.split(", "))
DONE = "micros BIGINT, offset BIGINT, forgotten BIGINT, timer BIGINT"  # the last edit worked off, how many are, the next timer
LEAST_FORGOTTEN = 16
MATCH = "wiki STRING, title STRING, reverter STRING, opponent STRING, started BIGINT, ended BIGINT, swing STRING"


def edit_wars_stream(clean: DataFrame, within_seconds: int = 600, delay_seconds: int = 15) -> DataFrame:
    """Append-mode matches of a stream of clean edits carrying `offset`."""
    check_positive("within_seconds", within_seconds)
    check_positive("delay_seconds", delay_seconds)
    edits = (
        clean.where(F.col("event_time").isNotNull() & F.col("wiki").isNotNull() & F.col("title").isNotNull())
        .withWatermark("event_time", f"{delay_seconds} seconds")
        .select(
            *PAGE,
            "event_time",
            F.unix_micros("event_time").alias("micros"),
            F.coalesce("offset", F.lit(0)).cast("bigint").alias("offset"),
            "user",
            # kept free of null numbers and flags, which pandas would turn into floats
            F.coalesce(~F.col("is_bot"), F.lit(False)).alias("person"),
            F.col("byte_delta").cast("string").alias("byte_delta"),
        )
    )
    matches = edits.groupBy(*PAGE).transformWithStateInPandas(
        FollowPage(within_seconds * 1_000_000), MATCH, "Append", "EventTime"
    )
    return matches.select(
        *PAGE,
        "reverter",
        "opponent",
        F.timestamp_micros("started").alias("started_at"),
        F.timestamp_micros("ended").alias("ended_at"),
        F.floor((F.col("ended") - F.col("started")) / 1_000_000).alias("seconds_elapsed"),
        E.wrapped_int(F.col("swing").cast("bigint")).alias("swing_bytes"),
    ).select(*schemas.names(schemas.EDIT_WAR))


class FollowPage(StatefulProcessor):
    """Waits for a page's edits to be settled by the watermark, and reports its revert sequences."""

    def __init__(self, within: int) -> None:
        self.within = within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.done = handle.getValueState("done", DONE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            edits = list(zip(*(batch[name].tolist() for name in EDIT), strict=True))
            if edits:
                self.waiting.appendList(edits)
                first = min(edits[0][0] if first is None else first, *(edit[0] for edit in edits))
        *place, timer = self._done()
        if first is not None and (timer is None or first // 1000 < timer):
            self._set(place, timer, first // 1000)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        micros, offset, forgotten, _ = self._done()
        waiting = sorted((edit for edit in map(tuple, self.waiting.get()) if micros is None or edit[:2] > (micros, offset)), key=_place)
        settled = bisect_right(waiting, watermark * 1000, key=lambda edit: edit[0])
        matches, done = _settled_matches(waiting, settled, watermark * 1000, self.within)
        rest = waiting[done:]
        if not rest:
            self.waiting.clear()
            self.done.clear()
        else:
            if done:
                micros, offset = waiting[done - 1][:2]
                forgotten += done
            if forgotten >= max(LEAST_FORGOTTEN, len(rest)):
                self.waiting.put(rest)
                forgotten = 0
            undecided = settled - done
            following = rest[undecided][0] if undecided < len(rest) else rest[0][0] + self.within
            self._set((micros, offset, forgotten), None, max(following // 1000, watermark + 1))
        if matches:
            yield pd.DataFrame([(*key, *match) for match in matches], columns=[f.split()[0] for f in MATCH.split(", ")])

    def _done(self) -> tuple:
        known = self.done.get() if self.done.exists() else None
        return tuple(known) if known is not None else (None, None, 0, None)

    def _set(self, place, before: int | None, timer: int) -> None:
        """Note how far the list has been worked off, and put one timer in the place of another."""
        if before is not None:
            self.handle.deleteTimer(before)
        self.handle.registerTimer(timer)
        self.done.update((*place, timer))

    def close(self) -> None:
        pass


def _place(edit: tuple) -> tuple:
    return edit[:2]


def _settled_matches(edits: list[tuple], settled: int, watermark: int, within: int) -> tuple[list[tuple], int]:
    """Matches among the settled edits, and how many leading edits can be forgotten."""
    matches, at = [], 0
    while at < settled:
        start, _, user, person, _ = edits[at]
        if at + 2 < settled:
            _, _, opponent, opponent_person, opponent_delta = edits[at + 1]
            end, _, last_user, _, last_delta = edits[at + 2]
            known = user is not None and opponent is not None and last_user is not None
            if known and person and opponent_person and opponent != user and last_user == user and end - start < within:
                deltas = (opponent_delta, last_delta)
                swing = None if None in deltas else str(sum(map(int, deltas)))
                matches.append((user, opponent, start, end, swing))
                at += 3
                continue
        elif watermark < start + within:
            break
        at += 1
    return matches, at
