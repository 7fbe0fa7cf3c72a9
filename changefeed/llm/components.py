"""Connected components of an edge table: a union-find in every task, then rounds between tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from changefeed.session import scratch_table

HOT_KEYS = 10_000
LEAST_HOT = 1_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, safe from lost executors."""
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Like `stored`, and what the given aggregates come to; they are taken while the rows are written."""
    seen = Observation(name)
    return stored(df.observe(seen, *(column.alias(key) for key, column in measures.items())), name), seen.get


def join_spread(rows: DataFrame, table: DataFrame, keys: list[str], total: int) -> DataFrame:
    """`rows` left-joined with a table that has one row per key and says in `n` how many of `total` rows have it.

    Keys that hold more than one in HOT_KEYS of all rows, so fewer than HOT_KEYS of them, are sent to
    every task; their rows stay where they are or are spread. All others fit a task with room to spare.
    """
    limit = max(LEAST_HOT, total // HOT_KEYS)
    values = [name for name in table.columns if name not in (*keys, "n")]
    hot = table.where(F.col("n") > limit).select(*keys, F.struct(F.lit(True).alias("found"), *values).alias("_hot"))
    cold = table.where(F.col("n") <= limit).select(*keys, F.lit(0).cast("bigint").alias("_salt"), F.struct(*values).alias("_cold"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    salt = F.when(F.col("_hot").isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(*(c for c in rows.columns if c not in keys)))
    joined = marked.withColumn("_salt", salt).join(cold, [*keys, "_salt"], "left")
    return joined.select(*rows.columns, *(F.coalesce(F.col(f"_hot.{name}"), F.col(f"_cold.{name}")).alias(name) for name in values))


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it that the table has no column of."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def union(parent: dict[int, int], a: int, b: int) -> None:
    a, b = find(parent, a), find(parent, b)
    if a != b:
        parent[max(a, b)] = min(a, b)


def find(parent: dict[int, int], x: int) -> int:
    root = x
    while (up := parent.get(root, root)) != root:
        root = up
    while x != root:
        parent[x], x = root, parent.get(x, x)
    return root


def task_forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one task as stars around each tree's smallest node; at most one edge per node stays."""
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            union(parent, a, b)
    nodes = [x for x in parent if find(parent, x) != x]
    roots = [parent[x] for x in nodes]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b), both BIGINT; the component is its smallest node.

    Each task first reduces its edges to a forest. Large-star and small-star rounds (Kiveris et
    al., "Connected Components in MapReduce and Beyond", 2014) then join what different tasks hold
    of a tree, in a number of rounds that grows with the logarithm of the edges. A node with many
    edges costs a map-side minimum and a join that AQE can split. Each round is written to the shared folder.
    Edges with a null end and loops add nothing; no edges give no rows.
    """
    stars = edges.select("a", "b").where("a <> b").mapInArrow(task_forest, "a BIGINT, b BIGINT")
    mixed = F.xxhash64("a", "b")
    state = {"rows": F.count("*"), "bits": F.bit_xor(mixed), "low": F.sum(mixed.bitwiseAND(0xFFFFFFFF))}
    stars, now = measured(stars.distinct(), "stars", **state)
    before = None
    while now != before and now["rows"]:
        before = now
        stars, now = measured(small_star(large_star(stars)), "stars", **state)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def large_star(stars: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    larger = both.where("b > a")
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def small_star(stars: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them. Input has b < a."""
    least = stars.groupBy("a").agg(F.min("b").alias("least"))
    others = stars.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionByName(least.withColumnRenamed("least", "b")).distinct()
