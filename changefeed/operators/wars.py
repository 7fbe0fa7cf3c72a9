"""A-B-A revert sequences: one editor, another, and the first again, in adjacent edits of a page.

A match is three adjacent edits of one page, first to last in less than the time limit; the
first two are not by bots. Matches do not overlap: after one, the search goes on behind its
last edit. Order is event time, then offset.

Finding the triples needs only an edit's two successors. Choosing among overlapping triples is
sequential by nature, but depends on little: how many edits ago (0, 1, or 2) the last chosen
triple began. That "distance" is computed with running window sums, without collecting rows:

* a triple starting three or more edits after the previous triple is always chosen;
* one edit after it, the distance grows by one, and three means chosen;
* two edits after it, the distance becomes 2 if it was 0 and else 0 (chosen).

A page with very many edits is cut into slices of bounded size that overlap by two edits. Each
slice is worked out for all three distances it may start with, and the slices' results, one
small row each, are then chained.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed import schemas
from changefeed.functions import edits as E
from changefeed.session import checkpointed
from changefeed.settings import check_positive

PAGE = ("wiki", "title")
ORDER = ("event_time", "offset")
USED = (*PAGE, "user", "is_bot", "byte_delta", *ORDER)

HOT_PAGE_EDITS = 1_000_000
SLICE_EDITS = 500_000
SLICES_PER_SORT_TASK = 8
SORT_TASK_EDITS = SLICES_PER_SORT_TASK * SLICE_EDITS
BROADCAST_PAGES = 100_000
CHAIN_FAN = 64


def edit_wars(
    clean: DataFrame,
    within_seconds: int = 600,
    hot_page_edits: int = HOT_PAGE_EDITS,
    slice_edits: int = SLICE_EDITS,
) -> DataFrame:
    """Revert sequences of a bounded table of clean edits carrying `offset`.

    Counts the edits per page first (two columns, combined before the shuffle). Pages of at
    most `hot_page_edits` are handled whole, with a single shuffle of the edits; larger ones
    go through `_sliced_matches`. The input is thus read two to four times: give a stored table.
    """
    check_positive("within_seconds", within_seconds)
    edits = clean.where(F.col("event_time").isNotNull()).select(*USED)
    hot = edits.groupBy(*PAGE).agg(F.count("*").alias("edits")).where(F.col("edits") > hot_page_edits)
    size = hot.agg(F.count("*").alias("pages"), F.sum("edits").alias("edits")).first()
    if not size["pages"]:
        return _page_matches(edits, within_seconds)

    hot = checkpointed(hot.select(*PAGE))
    if size["pages"] <= BROADCAST_PAGES:
        hot = F.broadcast(hot)
    same_page = [edits[name].eqNullSafe(hot[name]) for name in PAGE]
    small_pages = edits.join(hot, same_page, "left_anti")
    large_pages = edits.join(hot, same_page, "left_semi")
    return _page_matches(small_pages, within_seconds).unionByName(
        _sliced_matches(large_pages, size["edits"], within_seconds, slice_edits)
    )


def _page_matches(edits: DataFrame, within_seconds: int) -> DataFrame:
    position = F.row_number().over(Window.partitionBy(*PAGE).orderBy(*ORDER))
    triples = _triples(edits.withColumn("pos", position), PAGE, within_seconds)
    return _report(_distances(triples, PAGE, starts=(0,)).where("distance_0 = 0"))


def _sliced_matches(edits: DataFrame, n_edits: int, within_seconds: int, slice_edits: int) -> DataFrame:
    piece = ("slice", *PAGE)
    sliced = _slices(_positions(edits, n_edits, slice_edits), slice_edits)
    triples = _triples(sliced, piece, within_seconds).where("own")
    worked = _distances(triples, piece, starts=(0, 1, 2))
    entry = _entry_distances(worked, piece)
    same_piece = [worked[name].eqNullSafe(entry[name]) for name in piece]
    distance = F.element_at(F.array("distance_0", "distance_1", "distance_2"), entry["entry"] + 1)
    return _report(worked.join(entry, same_piece).where(distance == 0).select(worked["*"]))


def _triples(edits: DataFrame, piece: Sequence[str], within_seconds: int) -> DataFrame:
    """Every edit that starts a match when overlaps are ignored, with `gap`, its distance in
    edits from the previous such start (3 standing for more, or none)."""
    w = Window.partitionBy(*piece).orderBy(*ORDER)
    starts = edits.select(
        *edits.columns,
        F.lead("user", 1).over(w).alias("opponent"),
        F.lead("is_bot", 1).over(w).alias("opponent_is_bot"),
        F.lead("byte_delta", 1).over(w).alias("opponent_delta"),
        F.lead("user", 2).over(w).alias("last_user"),
        F.lead("byte_delta", 2).over(w).alias("last_delta"),
        F.lead("event_time", 2).over(w).alias("ended_at"),
    ).where(
        ~F.col("is_bot")
        & (F.col("opponent") != F.col("user"))
        & ~F.col("opponent_is_bot")
        & (F.col("last_user") == F.col("user"))
        & (F.col("ended_at") < F.col("event_time") + F.make_dt_interval(secs=F.lit(within_seconds)))
    )
    gap = F.least(F.col("pos") - F.lag("pos").over(w), F.lit(3))
    return starts.withColumn("gap", F.coalesce(gap, F.lit(3)))


def _distances(triples: DataFrame, piece: Sequence[str], starts: Sequence[int]) -> DataFrame:
    """Add `distance_d` for each `d` in `starts`: edits since the last chosen start, if the triple
    before the first one here had distance `d`. Zero means the triple itself is chosen.

    Between two gaps of 2 the distance only grows by one each time (modulo 3). A gap of 2 sets
    it to 0 or 2; seen from the value set by the gap of 2 before, with `ones` gaps of 1 in
    between, it is swapped when ones % 3 = 0, kept when 1, and set to 0 when 2. Running counts of the
    swaps since the last fixed value therefore give the distance everywhere.
    """
    w = Window.partitionBy(*piece).orderBy(*ORDER)
    up_to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    col = F.col

    turning = F.when(col("gap") > 1, col("n"))
    counted = (
        triples.withColumn("n", F.row_number().over(w))
        .withColumn("turn", F.max(turning).over(up_to_here))
        .withColumn("previous_turn", F.max(turning).over(before))
        .withColumn("ones", col("n") - F.coalesce("previous_turn", F.lit(0)) - 1)
    )
    first_turn = (col("gap") == 2) & col("previous_turn").isNull()
    later_turn = (col("gap") == 2) & col("previous_turn").isNotNull()
    fixed = (col("gap") == 3) | first_turn | (later_turn & (col("ones") % 3 == 2))
    swapped = later_turn & (col("ones") % 3 == 0)

    def fixed_value(start: int) -> Column:
        after_first = F.when((col("ones") + start) % 3 == 0, 2).otherwise(0)
        return F.when(first_turn, after_first).otherwise(0).alias(f"value_{start}")

    traced = counted.withColumn("swaps", F.count_if(swapped).over(up_to_here)).withColumn(
        "base",
        F.last(
            F.when(fixed, F.struct("swaps", *[fixed_value(start) for start in starts])), ignorenulls=True
        ).over(up_to_here),
    )

    def distance(start: int) -> Column:
        value = col(f"base.value_{start}")
        even = (col("swaps") - col("base.swaps")) % 2 == 0
        at_turn = F.when(even, value).otherwise(2 - value)
        here = F.when(col("turn").isNull(), col("n") + start).otherwise(at_turn + col("n") - col("turn"))
        return (here % 3).cast("int")

    return traced.withColumns({f"distance_{start}": distance(start) for start in starts}).drop(
        "n", "turn", "previous_turn", "ones", "swaps", "base"
    )


def _positions(edits: DataFrame, n_edits: int, slice_edits: int) -> DataFrame:
    """Number the edits 0, 1, 2, ... in order of page and time, without sorting them in one task.

    The range partitions are numbered inside and then shifted by the sizes of those before.
    They are stored, since both the sizes and the rows must come from the same ranges.
    """
    tasks = _sort_tasks(n_edits, slice_edits, int(edits.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = checkpointed(
        edits.repartitionByRange(tasks, *PAGE, *ORDER)
        .sortWithinPartitions(*PAGE, *ORDER)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    located = ranged.withColumn("_task", F.shiftright("_id", 33)).withColumn(
        "_in_task", F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    )
    earlier_tasks = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        located.groupBy("_task")
        .agg(F.count("*").alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(earlier_tasks), F.lit(0)).alias("_shift"))
    )
    return (
        located.join(shifts, "_task")
        .withColumn("pos", F.col("_shift") + F.col("_in_task"))
        .drop("_id", "_task", "_in_task", "_shift")
    )


def _sort_tasks(n_edits: int, slice_edits: int, partitions: int) -> int:
    """Some slices for each task, but no more tasks than the session's shuffles have, as long as these need not
    take more than SORT_TASK_EDITS: the slices may be small, and every task writes a file."""
    return max(ceil(n_edits / SORT_TASK_EDITS), min(ceil(n_edits / (slice_edits * SLICES_PER_SORT_TASK)), partitions))


def _slices(positioned: DataFrame, slice_edits: int) -> DataFrame:
    """Cut positions into slices; the two edits on either side of a cut go to both slices."""
    if slice_edits < 4:
        raise ValueError("slice_edits must be at least 4")
    home = F.floor(F.col("pos") / slice_edits)
    rest = F.col("pos") % slice_edits
    copies = (
        F.when(rest < 2, F.array(home, home - 1))
        .when(rest >= slice_edits - 2, F.array(home, home + 1))
        .otherwise(F.array(home))
    )
    return positioned.withColumn("slice", F.explode(copies)).withColumn("own", F.col("slice") == home)


def _entry_distances(worked: DataFrame, piece: Sequence[str], fan: int = CHAIN_FAN) -> DataFrame:
    """The distance each slice of a page starts with, from the slices before it.

    A slice's result is where it ends for each of the three starts: a map from three states to three.
    Such maps are composed like numbers are added, so the entries are a prefix scan: `fan` slices are
    composed into one map, `fan` of these into the next, until a page has one group; then the entry of a
    group is handed down to its members through those before them. No list is longer than `fan`,
    however many slices a page has and whatever their maps.
    """
    ends = F.array("distance_0", "distance_1", "distance_2")
    maps = checkpointed(worked.groupBy(*piece).agg(F.max_by(ends, "pos").alias("ends")))
    last = maps.agg(F.max("slice").alias("last")).first()["last"]

    def level(nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("group", F.floor(F.col("node") / fan))

    levels = [level(maps.select(*PAGE, F.col("slice").alias("node"), "ends"))]
    while last is not None and last >= fan:
        members = F.sort_array(F.collect_list(F.struct("node", "ends"))).getField("ends")
        grouped = levels[-1].groupBy(*PAGE, "group").agg(members.alias("members"))
        composed = F.transform(F.array(*map(F.lit, range(3))), lambda start: _through(F.col("members"), start))
        levels.append(level(checkpointed(grouped.select(*PAGE, F.col("group").alias("node"), composed.alias("ends")))))
        last //= fan

    entries: DataFrame | None = None
    for nodes in reversed(levels):
        if entries is None:
            started = nodes.withColumn("start", F.lit(0))
        else:
            above = entries.select(*[F.col(name).alias(f"_{name}") for name in PAGE], F.col("node").alias("_group"), F.col("entry").alias("start"))
            same = [nodes[name].eqNullSafe(above[f"_{name}"]) for name in PAGE]
            started = nodes.join(above, [*same, nodes["group"] == above["_group"]])
        before = Window.partitionBy(*PAGE, "group").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        entry = _through(F.collect_list("ends").over(before), F.col("start"))
        entries = started.select(*PAGE, "node", entry.alias("entry"))
    return entries.select(*PAGE, F.col("node").alias("slice"), "entry")


def _through(maps: Column, start: Column) -> Column:
    """The state behind a list of maps, entered with `start`."""
    return F.aggregate(maps, start, lambda state, ends: F.element_at(ends, state + 1))


def _report(chosen: DataFrame) -> DataFrame:
    swing = F.col("opponent_delta").cast("bigint") + F.col("last_delta")
    return chosen.select(
        *PAGE,
        F.col("user").alias("reverter"),
        "opponent",
        F.col("event_time").alias("started_at"),
        "ended_at",
        F.timestamp_diff("SECOND", F.col("event_time"), F.col("ended_at")).alias("seconds_elapsed"),
        E.wrapped_int(swing).alias("swing_bytes"),
    ).select(*schemas.names(schemas.EDIT_WAR))
