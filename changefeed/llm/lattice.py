"""Near-duplicate embeddings by lattice hashing.

Vectors are projected at random to eight dimensions, twice per table, and each projection is
decoded to the nearest point of the lattice E8. The two points are the vector's home cell in that
table; next to it, the cells it comes closest to are probed. Vectors that share a cell which is home to one
of them are compared by their cosine.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from changefeed.llm.components import connected_components, stored
from changefeed.llm.words import RUN, U, mix

COSINE = 0.95
TABLES, LATTICES, PROBES = 8, 2, 2
SCALE = 0.45  # recall at a cosine of exactly 0.95 is over 0.99, see the tests
BLOCK = 512
SEED = 20240303


@cache
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: from each lattice point to its neighbours."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    halves = [np.array(s) / 2 for s in product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(whole + halves)


def nearest_even(y: np.ndarray) -> np.ndarray:
    """The nearest point of D8: whole coordinates with an even sum."""
    point = np.rint(y)
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    if len(odd):
        rest = y[odd] - point[odd]
        worst = np.abs(rest).argmax(axis=1)
        point[odd, worst] += np.where(rest[np.arange(len(odd)), worst] >= 0, 1, -1)
    return point


def decode(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8, which is D8 and D8 moved by a half in every coordinate."""
    a, b = nearest_even(y), nearest_even(y - 0.5) + 0.5
    nearer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


@cache
def projections(dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([SEED, dimensions])
    return random.normal(size=(TABLES, LATTICES, 8, dimensions)) * SCALE, random.random((TABLES, LATTICES, 8))


def cell_hash(points: np.ndarray, table: int, lattice: int) -> np.ndarray:
    doubled = np.rint(points * 2).astype(np.int64).astype(U)
    total = np.full(points.shape[:-1], U(table * LATTICES + lattice + 1))
    for k in range(8):
        total = total + doubled[..., k] * RUN[k]
    return mix(total)


def cell_keys(unit: np.ndarray) -> np.ndarray:
    """(vectors, tables, 1 + probes) 32-bit cell keys; the home cell first. A probe equal to an earlier cell is 0."""
    matrix, shift = projections(unit.shape[1])
    out = np.zeros((len(unit), TABLES, 1 + PROBES), np.uint32)
    for table in range(TABLES):
        homes, moves, gains = [], [], []
        for lattice in range(LATTICES):
            y = np.einsum("nd,kd->nk", unit, matrix[table, lattice]) + shift[table, lattice]
            home = decode(y)
            gain = (y - home) @ roots().T
            best = np.argpartition(-gain, PROBES, axis=1)[:, :PROBES]
            homes.append(cell_hash(home, table, lattice))
            moves.append(cell_hash(home[:, None, :] + roots()[best], table, lattice))
            gains.append(np.take_along_axis(gain, best, axis=1))
        total = np.sum(homes, axis=0, dtype=U)
        moved = np.concatenate([total[:, None] - h[:, None] + m for h, m in zip(homes, moves, strict=True)], axis=1)
        order = np.argsort(-np.concatenate(gains, axis=1), axis=1, kind="stable")[:, :PROBES]
        cells = np.concatenate([total[:, None], np.take_along_axis(moved, order, axis=1)], axis=1)
        keys = (mix(cells ^ U(table + 1)) >> U(32)).astype(np.uint32) | np.uint32(1)
        for k in range(1, 1 + PROBES):
            keys[:, k][(keys[:, :k] == keys[:, k : k + 1]).any(axis=1)] = 0
        out[:, table] = keys
    return out


def whole_powers(x: np.ndarray) -> np.ndarray:
    """Each vector over a power of two, which is exact, so that no square overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def keyed(code: str):
    """Adds to (id, copies, x) the vector as bytes and its cell keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.array(v, code) for v in batch.column("x").to_pylist()]
            packed = [b""] * len(vectors)
            lengths = np.array([len(v) for v in vectors])
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                x = np.array([vectors[k] for k in rows], float)
                x = whole_powers(x)
                for k, keys in zip(rows, cell_keys(x / np.linalg.norm(x, axis=1, keepdims=True)), strict=True):
                    packed[k] = keys.tobytes()
            columns = [pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("copies"), pa.array(lengths.astype(np.int64)), *columns],
                ["id", "copies", "length", "vector", "keys"],
            )

    return run


KEYED = "id BIGINT, copies BIGINT, length BIGINT, vector BINARY, keys BINARY"


def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, home, id) for every cell of every vector; a place is a length, a table and a key."""
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.uint32)
        keys = keys.reshape(len(batch), TABLES, 1 + PROBES)
        table = np.arange(TABLES, dtype=np.int64)[None, :, None] << 32
        place = (keys.astype(np.int64) | table) ^ (batch.column("length").to_numpy() << 40)[:, None, None]
        owner, _, probe = np.nonzero(keys)
        ids = batch.column("id").to_numpy()[owner]
        yield pa.RecordBatch.from_arrays(
            [pa.array(place[keys != 0]), pa.array(probe == 0), pa.array(ids)], ["place", "home", "id"]
        )


def unpack(items: pa.StructArray, code: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = items.field("id").to_numpy(zero_copy_only=False)
    copies = items.field("copies").to_numpy(zero_copy_only=False)
    vectors = np.frombuffer(b"".join(items.field("vector").to_pylist()), code).reshape(len(ids), -1).astype(float)
    vectors = whole_powers(vectors)
    keys = np.frombuffer(b"".join(items.field("keys").to_pylist()), np.uint32).reshape(len(ids), TABLES, 1 + PROBES)
    return ids, copies, vectors, keys


def met_before(a: np.ndarray, b: np.ndarray, table: int, key: int) -> np.ndarray:
    """Whether pairs with these keys share a cell in an earlier table, or in this one with a smaller key."""
    home = a[:, :, 0] == b[:, :, 0]
    by_a = (a[:, :, :1] == b[:, :, 1:]).any(axis=2)
    by_b = (b[:, :, :1] == a[:, :, 1:]).any(axis=2)
    earlier = (home | by_a | by_b)[:, :table].any(axis=1)
    here = (by_a[:, table] & (a[:, table, 0] < key)) | (by_b[:, table] & (b[:, table, 0] < key))
    return earlier | here


def comparer(code: str):
    """Of each pair of blocks: (id, links found here first), and (id, peer) edges that join all that is linked."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("place").to_pylist()
            same = batch.column("same").to_pylist()
            for k, (left, right) in enumerate(zip(batch.column("left"), batch.column("right"), strict=True)):
                ids_a, copies_a, x, keys_a = unpack(left.values, code)
                ids_b, copies_b, y, keys_b = unpack(right.values, code)
                norms = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :]
                linked = (x @ y.T) / norms >= COSINE
                linked &= ids_a[:, None] < ids_b[None, :] if same[k] else ids_a[:, None] != ids_b[None, :]
                i, j = np.nonzero(linked)
                if not len(i):
                    continue
                table, key = (places[k] >> 32) & 0xFF, places[k] & 0xFFFFFFFF
                new = ~met_before(keys_a[i], keys_b[j], table, key)
                links_a = np.bincount(i[new], weights=copies_b[j[new]], minlength=len(ids_a)).astype(np.int64)
                links_b = np.bincount(j[new], weights=copies_a[i[new]], minlength=len(ids_b)).astype(np.int64)
                root_a, root_b = ids_a.copy(), ids_b.copy()
                while True:
                    before = root_a, root_b
                    root_a = np.minimum(root_a, np.where(linked, root_b[None, :], root_a[:, None]).min(axis=1))
                    root_b = np.minimum(root_b, np.where(linked, root_a[:, None], root_b[None, :]).min(axis=0))
                    if (root_a == before[0]).all() and (root_b == before[1]).all():
                        break
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([ids_a, ids_b])),
                        pa.array(np.concatenate([links_a, links_b])),
                        pa.array(np.concatenate([root_a, root_b])),
                    ],
                    ["id", "links", "peer"],
                )

    return compare


def near_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of `embeddings` (vec_id BIGINT, embedding ARRAY, more ignored).

    Vectors are linked at a cosine of 0.95 or more in double precision; n_links counts the other rows
    linked directly, component_id is the smallest vec_id reachable, kept tells whether it is the
    row's own. Every link returned is exact; a pair is missed if it shares no cell in any table.

    Null, empty or zero vectors, those with null or non-finite components and rows without a vec_id
    link with nothing; the latter have no component and are kept. Only vectors of the same length
    are compared. Rows that repeat a vec_id count as copies of each other if their vectors are
    equal. An empty table gives no rows.

    Equal vectors are one candidate with a number of copies. A crowded cell is cut into blocks of
    some 512 vectors, and pairs of blocks are compared as matrices, in as many tasks as there are;
    counts and a spanning forest leave a task, never the pairs.
    """
    element = embeddings.schema["embedding"].dataType.elementType
    code = "<f4" if element == FloatType() else "<f8"
    values = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), values.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    good = F.col("vec_id").isNotNull() & finite & F.exists("x", lambda v: v != 0)
    rows = rows.withColumn("x", F.when(good, F.col("x")))
    classes = rows.where("x is not null").groupBy("x").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    classes = stored(classes, "vectors")
    vectors = stored(classes.mapInArrow(keyed(code), KEYED), "keys")

    placed = vectors.select("id", "length", "keys").mapInArrow(cells, "place BIGINT, home BOOLEAN, id BIGINT")
    sizes = placed.groupBy("place").agg(
        F.count_if(F.col("home")).alias("homes"), F.count_if(~F.col("home")).alias("probes")
    )
    crowd = placed.join(sizes.where("homes > 1 or (homes > 0 and probes > 0)"), "place")
    blocks = F.ceil(F.when(F.col("home"), F.col("homes")).otherwise(F.col("probes")) / F.lit(BLOCK)).cast("bigint")
    crowd = crowd.select("place", "home", "id", F.pmod(F.xxhash64("id"), blocks).alias("block"))
    item = F.struct("id", "copies", "vector", "keys")
    grouped = crowd.join(vectors, "id").groupBy("place", "home", "block").agg(F.collect_list(item).alias("items"))
    grouped = stored(grouped, "blocks")
    homes = grouped.where("home").select("place", F.col("block").alias("left_block"), F.col("items").alias("left"))
    others = grouped.select("place", "home", F.col("block").alias("right_block"), F.col("items").alias("right"))
    pairs = homes.join(others, "place").where("not home or left_block <= right_block")
    same = F.col("home") & (F.col("left_block") == F.col("right_block"))
    pairs = pairs.select("place", same.alias("same"), "left", "right")
    found = stored(pairs.mapInArrow(comparer(code), "id BIGINT, links BIGINT, peer BIGINT"), "links")
    components = connected_components(found.select(F.col("id").alias("a"), F.col("peer").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.join(links, "id", "left").join(components.withColumnRenamed("node", "id"), "id", "left")
    out = rows.join(known, "x", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "id", "vec_id"))
    return out.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
