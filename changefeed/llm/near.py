"""Near-duplicate sets: banded sketches, exact Jaccard verification, connected components.

Texts whose sketches share a band fall into one bucket. Pairs inside a bucket are never listed:

1. Every member is verified against the bucket's smallest id, the hub. Links give components.
2. Where a bucket still holds members outside the hub's component, these are compared with
   that component and with each other, in blocks of bounded size: first the sketches, then,
   where those agree in a share of bins not far below the threshold, the whole sets, in the
   same task.

So no link that banding finds is lost to the choice of a hub, a group of n near copies costs about
n rows instead of n^2, and only links leave a task. Where blocks are compared, sketches of two sets
that just reach a threshold of 0.75 disagree so far that they are not looked at about once in ten
million times, at 0.8 more seldom still.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.llm.components import connected_components, measured, stored
from changefeed.llm.sketch import bands, compact, sketches
from changefeed.llm.words import PIECE_CHARS, slices
from changefeed.llm.workers import tidy

KEYS_HELD = 1 << 18
PART_KEYS = 1 << 20
BLOCK = 512
BLOCK_BYTES = 1_000_000
BLOCK_BINS = 192
BLOCK_PAIRS = 1 << 14
PARITY_BITS = 11
PARITY_CHUNK = 1 << 19
BLOCK_SLACK = 0.17  # of the bins, by which sketches may agree less than the sets do: over five standard deviations


@dataclass(frozen=True)
class Likeness:
    """shingles: flat hashes and set sizes of texts; bins and rows: of the banding; percent: least
    Jaccard similarity of a link."""

    shingles: Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]
    bins: int
    rows: int
    percent: int

    def sketch(self, texts: list[str | None], bins: int) -> np.ndarray:
        parts = [sketches(*self.shingles(part), bins) for part in slices(texts, PIECE_CHARS)]
        return np.concatenate([np.zeros((0, bins), np.uint64), *parts])

    def keys(self, texts: list[str | None]) -> np.ndarray:
        return bands(self.sketch(texts, self.bins), self.rows)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The set of each text, sorted."""
        found = []
        for part in slices(texts, PIECE_CHARS):
            flat, sizes = self.shingles(part)
            ends = np.cumsum(sizes).tolist()
            for start, end in zip([0, *ends], ends, strict=False):
                items = np.sort(flat[start:end])
                found.append(items[np.append(items[:-1] != items[1:], True)] if len(items) else items)
        return found

    def alike(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two sorted sets are a link."""
        if not len(a) or not len(b) or 100 * min(len(a), len(b)) < self.percent * max(len(a), len(b)):
            return False
        places = np.minimum(np.searchsorted(b, a), len(b) - 1)
        shared = int(np.count_nonzero(b[places] == a))
        return 100 * shared >= self.percent * (len(a) + len(b) - shared)

    def may_link(self, left: list[np.ndarray], right: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the pairs (x, y) of places in the two lists of sets may be links. Sets that differ in d items
        differ in at most d of their parities, so no link is lost."""
        size = [np.fromiter(map(len, sets), np.int64, len(sets)) for sets in (left, right)]
        differ = np.bitwise_count(parities(left)[x] ^ parities(right)[y]).sum(axis=1, dtype=np.int64)
        return (100 - self.percent) * (size[0][x] + size[1][y]) >= (100 + self.percent) * differ


def near_components(keys: DataFrame, fetch: Callable[[DataFrame], DataFrame], likeness: Likeness) -> DataFrame:
    """(node, component) of all ids that have a link.

    keys: (id, key), one row per band, an id at most a few times per key. fetch: gives (id, text)
    of the ids asked for.
    """
    return bucket_components(bucket_members(keys).select("id", "hub"), fetch, likeness)


def bucket_components(members: DataFrame, fetch: Callable[[DataFrame], DataFrame], likeness: Likeness) -> DataFrame:
    """(node, component) of all ids that have a link. members: (id, hub) of every bucket, its hub included."""
    members = stored(members, "buckets")
    texts = stored(fetch(members.select("id").distinct()), "texts")
    first = members.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = stored(verified(first, texts, likeness), "links")
    labels = connected_components(links)
    more, found = measured(residual_links(members, labels, texts, likeness), "links", rows=F.count("*"))
    return connected_components(links.unionByName(more)) if found["rows"] else labels


def bucket_members(keys: DataFrame) -> DataFrame:
    """(key, id, hub) of buckets with several ids. One shuffle of narrow rows, sorted in each task and
    read as a stream, so that no bucket is held in memory."""
    return keys.repartition("key").sortWithinPartitions("key", "id").mapInArrow(tidy(shared_keys), "key BIGINT, id BIGINT, hub BIGINT")


def shared_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, id), those whose key has several ids, each once, with its smallest id."""
    last: tuple[int, int, int] | None = None  # key, id and hub of the row before
    alone = False  # whether that row is the only one of its key so far
    for batch in batches:
        key, item = batch.column("key").to_numpy(), batch.column("id").to_numpy()
        hub_before = np.zeros(0, np.int64)
        if last is not None:
            key, item = np.append(last[0], key), np.append(last[1], item)
            hub_before = np.array([last[2]])
        fresh = np.append(True, (key[1:] != key[:-1]) | (item[1:] != item[:-1])) if len(key) else np.zeros(0, bool)
        key, item = key[fresh], item[fresh]
        if not len(key):
            continue
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        hubs = item[starts]
        hubs[: len(hub_before)] = hub_before
        sizes = np.diff(np.append(starts, len(key)))
        several = sizes > 1
        hub = np.repeat(hubs, sizes)
        out = np.repeat(several, sizes)
        if last is not None and not alone:
            out[0] = False  # has been given already
        previous = last
        last = (key[-1], item[-1], hub[-1])
        if len(starts) > 1 or previous is None:
            alone = bool(sizes[-1] == 1)
        else:
            alone = alone and bool(sizes[-1] == 1)
        yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(item[out]), pa.array(hub[out])], ["key", "id", "hub"])


def key_parts(spark: SparkSession, keys: int) -> int:
    """So many parts for so many keys that a part fits a task: the session's shuffle partitions, or more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys // PART_KEYS))


def packed(ids: np.ndarray, keys: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each part that the keys are dealt to: (part, keys, ids), side by side in two lists."""
    part = (((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.uint16 if parts < 1 << 16 else np.int32)
    order = np.argsort(part, kind="stable")
    counts = np.bincount(part, minlength=parts)
    filled = np.flatnonzero(counts)
    bounds = np.append(0, np.cumsum(counts[filled])).astype(np.int32)
    lists = [pa.ListArray.from_arrays(bounds, column[order]) for column in (keys, ids)]
    return pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), *lists], ["part", "keys", "ids"])


PACKED = "part INT, keys ARRAY<BIGINT>, ids ARRAY<BIGINT>"


def packed_members(rows: DataFrame, parts: int) -> DataFrame:
    """(id, hub) of buckets with several ids, from rows as `packed` makes them for so many parts.

    A part is a fixed share of all keys, dealt to a task of its own. The task holds each key once, with
    its hub, but not the members, so a bucket may be of any size.
    """
    return rows.repartitionById(parts, "part").mapInArrow(tidy(first_met), "id BIGINT, hub BIGINT")


def first_met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, hub) for keys met with several ids, (hub, hub) too; the hub is the smallest id of those a key was first met with."""
    names = hubs = np.zeros(0, np.int64)  # the keys met so far and their hubs
    for key, item in key_columns(batches):
        met = len(names)
        key, item = np.append(names, key), np.append(hubs, item)
        order = np.argsort(key)
        key, item, fresh = key[order], item[order], order >= met
        starts = np.append(True, key[1:] != key[:-1])
        again = ~starts
        several = again | np.append(again[1:], False)  # rows of a key with more than one row
        place = np.flatnonzero(several)
        ranked = place[np.lexsort((item[place], fresh[place], key[place]))]
        item[place] = item[ranked]
        first = np.flatnonzero(starts)
        names, hubs = key[first], item[first]
        hub = np.repeat(hubs, np.diff(np.append(first, len(key))))
        other = item != hub
        pairs = np.stack([np.append(item[other], hub[other]), np.append(hub[other], hub[other])])
        pairs = pairs[:, np.lexsort(pairs)]
        pairs = pairs[:, np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))] if pairs.size else pairs
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["id", "hub"])


def key_columns(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and ids of packed rows, some PART_KEYS at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if len(batch):
            held.append(tuple(batch.column(name).flatten().to_numpy() for name in ("keys", "ids")))
        if sum(len(keys) for keys, _ in held) >= 2 * PART_KEYS:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held = []
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def verified(pairs: DataFrame, texts: DataFrame, likeness: Likeness) -> DataFrame:
    """The pairs (a, b) that are links."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts_a in slices(batch.column("left").to_pylist()):
                part = batch.slice(done, len(texts_a))
                done += len(texts_a)
                # a hub stands in many pairs
                hubs = dict(zip(part.column("b").to_pylist(), part.column("right").to_pylist(), strict=True))
                set_of = dict(zip(hubs, likeness.sets(list(hubs.values())), strict=True))
                sides = zip(likeness.sets(texts_a), part.column("b").to_pylist(), strict=True)
                linked = np.fromiter((likeness.alike(x, set_of[b]) for x, b in sides), bool, len(part))
                yield part.select(["a", "b"]).filter(pa.array(linked))

    sides = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    sides = sides.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    return sides.select("a", "b", "left", "right").mapInArrow(tidy(check), "a BIGINT, b BIGINT")


def residual_links(members: DataFrame, labels: DataFrame, texts: DataFrame, likeness: Likeness) -> DataFrame:
    """Links (a, b) between different components that share a bucket.

    A member outside its hub's component is attached to that component. Each component with such
    members is a group: its own members, the core, and those attached. All attached ones are
    compared with the whole group, so each text goes to a group once, however many buckets it shares.
    """
    of = labels.select(F.col("node").alias("id"), "component")
    main_of = labels.select(F.col("node").alias("hub"), F.col("component").alias("main"))
    labelled = members.join(of, "id", "left").join(main_of, "hub", "left").select(
        "id", F.coalesce("component", "id").alias("component"), F.coalesce("main", "hub").alias("main")
    )
    labelled = stored(labelled.distinct(), "labelled")
    attached = labelled.where("component <> main").select(F.col("main").alias("group"), "id", "component").distinct()
    core = labelled.select(F.col("component").alias("group"), "id", "component").distinct()
    core = core.join(attached.select("group").distinct(), "group", "left_semi")
    everyone = attached.withColumn("minor", F.lit(True)).unionByName(core.withColumn("minor", F.lit(False)))

    lengths = texts.select("id", F.octet_length("text").alias("bytes"))
    sizes = F.greatest(F.ceil(F.count("*") / F.lit(BLOCK)), F.ceil(F.sum("bytes") / F.lit(BLOCK_BYTES)))
    sizes = everyone.join(lengths, "id").groupBy("group", "minor").agg(sizes.alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block")
    placed = everyone.join(sizes, ["group", "minor"]).select("group", "minor", block, "id", "component")

    def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = compact(likeness.sketch(batch.column("text").to_pylist(), BLOCK_BINS))
            sketch = pa.array([row.tobytes() for row in table], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), sketch, batch.column("text")], ["id", "sketch", "text"])

    wanted = texts.join(everyone.select("id").distinct(), "id", "left_semi").select("id", "text")
    profile = wanted.mapInArrow(tidy(sketched), "id BIGINT, sketch BINARY, text STRING")
    item = F.struct("id", "component", "sketch", "text")
    blocks = placed.join(profile, "id").groupBy("group", "minor", "block").agg(F.collect_list(item).alias("all"))
    blocks = stored(blocks, "blocks")
    left = blocks.where("minor").select("group", F.col("block").alias("left_block"), F.col("all").alias("left"))
    pairs = left.join(blocks, "group").where("not minor or left_block <= block").select("left", F.col("all").alias("right"))
    floor = (likeness.percent / 100 - BLOCK_SLACK) * BLOCK_BINS

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (Members(batch.column(side), likeness) for side in ("left", "right"))
            found: list[tuple[int, int]] = []
            joined: set[tuple[int, int]] = set()
            for x, y in block_pairs(a.bounds, b.bounds):
                near = (a.component[x] != b.component[y]) & (agreeing(a.table[x], b.table[y]) >= floor)
                x, y = x[near], y[near]
                sets_a, sets_b = a.sets(x), b.sets(y)
                (in_a, at_a), (in_b, at_b) = (np.unique(places, return_inverse=True) for places in (x, y))
                near = likeness.may_link([sets_a[k] for k in in_a.tolist()], [sets_b[m] for m in in_b.tolist()], at_a, at_b)
                x, y = x[near], y[near]
                joined = {link for link in joined if len(x) and link[0] == x[0]}  # a member's pairs follow each other
                for k, m in zip(x.tolist(), y.tolist(), strict=True):
                    link = (k, int(b.component[m]))  # one link to a component is enough
                    if link not in joined and likeness.alike(sets_a[k], sets_b[m]):
                        joined.add(link)
                        found.append((int(a.ids[k]), int(b.ids[m])))
            columns = list(zip(*found, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return pairs.mapInArrow(tidy(compare), "a BIGINT, b BIGINT").distinct()


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set a row of 2 ** PARITY_BITS bits: whether an odd number of its items falls into a bin."""
    table = np.zeros((len(sets), 1 << PARITY_BITS >> 6), np.uint64)
    filled = np.cumsum([len(items) + (1 << PARITY_BITS) for items in sets]) // PARITY_CHUNK
    for part in np.split(np.arange(len(sets)), np.flatnonzero(np.diff(filled)) + 1) if sets else ():
        bins = [(sets[k] >> np.uint64(64 - PARITY_BITS)).astype(np.int64) + (at << PARITY_BITS) for at, k in enumerate(part.tolist())]
        odd = np.bincount(np.concatenate(bins), minlength=len(part) << PARITY_BITS) & 1
        table[part] = np.packbits(odd.astype(bool)).view(np.uint64).reshape(len(part), -1)
    return table


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many of BLOCK_BINS bytes each row of a agrees with that of b."""
    eights = (a == b).view(np.uint64).sum(axis=1, dtype=np.uint64)  # eight counts side by side, each at most BLOCK_BINS / 8
    return (eights * np.uint64(0x0101010101010101)) >> np.uint64(56)


def block_pairs(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y) of all pairs of a left and a right member in one row, by row and x, about BLOCK_PAIRS at a time."""
    xs, ys, filled = [], [], 0
    for k in range(len(left) - 1):
        y = np.arange(right[k], right[k + 1])
        step = max(1, BLOCK_PAIRS // max(1, len(y)))
        for at in range(left[k], left[k + 1], step):
            x = np.arange(at, min(at + step, left[k + 1]))
            xs.append(np.repeat(x, len(y)))
            ys.append(np.tile(y, len(x)))
            filled += len(xs[-1])
            if filled >= BLOCK_PAIRS:
                yield np.concatenate(xs), np.concatenate(ys)
                xs, ys, filled = [], [], 0
    if filled:
        yield np.concatenate(xs), np.concatenate(ys)


class Members:
    """The members of a column of blocks: ids, components, sketches, and whole sets as they are asked for."""

    def __init__(self, blocks: pa.ListArray, likeness: Likeness) -> None:
        rows = blocks.flatten()
        self.bounds = np.concatenate([[0], np.cumsum(blocks.value_lengths().to_numpy(zero_copy_only=False))])
        self.ids = rows.field("id").to_numpy(zero_copy_only=False)
        self.component = rows.field("component").to_numpy(zero_copy_only=False)
        sketch = b"".join(rows.field("sketch").to_pylist())
        self.table = np.frombuffer(sketch, np.uint8).reshape(len(self.ids), BLOCK_BINS)
        self.texts, self.likeness = rows.field("text"), likeness
        self.known: dict[int, np.ndarray] = {}

    def sets(self, places: np.ndarray) -> dict[int, np.ndarray]:
        """The sets at these places; those of the last call are not worked out again."""
        wanted = np.unique(places)
        self.known = {k: self.known[k] for k in wanted.tolist() if k in self.known}
        missing = [k for k in wanted.tolist() if k not in self.known]
        self.known |= zip(missing, self.likeness.sets(self.texts.take(pa.array(missing, pa.int64())).to_pylist()), strict=True)
        return self.known
