"""Near-duplicate documents over word shingles: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.components import join_spread, measured, stored
from changefeed.llm.near import Likeness, near_components
from changefeed.llm.sketch import bands, sketches
from changefeed.llm.words import SPACES, U, ascii_lower, mix, runs, slices, text_words
from changefeed.llm.workers import tidy

SHINGLE_WORDS = 5
PERCENT = 75
BINS, ROWS = 128, 4  # 32 bands: a pair at the threshold is missed once in 200,000 times


def document_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, and how many there are."""
    found = [np.unique(runs(words, SHINGLE_WORDS)) for _, words in text_words(map(ascii_lower, texts), SPACES)]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.concatenate([np.zeros(0, U), *found]), sizes


LIKENESS = Likeness(document_sets, BINS, ROWS, PERCENT)


def parts_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts in parts of bounded size."""
    for batch in batches:
        done = 0
        for texts in slices(batch.column("text").to_pylist()):
            yield batch.column("doc_id").slice(done, len(texts)), texts
            done += len(texts)


def profiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, two sums that tell whole sets apart, and band keys."""
    for ids, texts in parts_of(batches):
        flat, sizes = document_sets(texts)
        sums = []
        for part in (flat, mix(flat ^ U(0xA5A5A5A5A5A5A5A5))):
            running = np.concatenate([np.zeros(1, U), np.cumsum(mix(part), dtype=U)])
            ends = np.cumsum(sizes)
            sums.append((running[ends] - running[ends - sizes]).astype(np.int64))
        keys = bands(sketches(flat, sizes, BINS), ROWS)
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(sizes),
                pa.array(sums[0]),
                pa.array(sums[1]),
                pa.ListArray.from_arrays(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32), keys.ravel()),
            ],
            ["doc_id", "n_shingles", "sum_a", "sum_b", "keys"],
        )


PROFILE = "doc_id BIGINT, n_shingles BIGINT, sum_a BIGINT, sum_b BIGINT, keys ARRAY<BIGINT>"
SAME = ["n_shingles", "sum_a", "sum_b"]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of `docs` (doc_id BIGINT, text STRING, more ignored).

    Words are runs of anything but ASCII white space, A to Z lowered. A document's set holds its
    distinct runs of five words, or all its words as one run if it has fewer. Documents are linked
    if 100 * common >= 75 * all of both sets; the component is the smallest doc_id reachable.

    Null, empty or wordless texts have an empty set and link with nothing. Rows that repeat a
    doc_id are one document, linked if any of its texts is. A row without a doc_id links with
    nothing, has no component and is kept. An empty table gives no rows.

    Equal sets are found by grouping and stand in for one document each, so thousands of copies
    cost one comparison. See `near` for what follows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile, seen = measured(rows.mapInArrow(tidy(profiles), PROFILE), "profiles", total=F.count("*"))
    grouped = profile.where("n_shingles > 0").groupBy(*SAME).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    classes = stored(grouped, "classes")
    reps = classes.select(*SAME, F.col("rep").alias("doc_id"))
    keys = profile.join(reps, [*SAME, "doc_id"], "left_semi").select(F.col("doc_id").alias("id"), F.explode("keys").alias("key"))

    def fetch(ids: DataFrame) -> DataFrame:
        named = rows.withColumnRenamed("doc_id", "id")
        return named.join(ids.hint("shuffle_hash"), "id", "left_semi").distinct()

    components = near_components(keys, fetch, LIKENESS).withColumnRenamed("node", "rep")
    # each class gets its component first, so that a class with many copies is joined with them once, and spread
    named = classes.join(components, "rep", "left").select(*SAME, "n", F.coalesce("component", "rep").alias("component"))
    placed = join_spread(profile.drop("keys"), named, SAME, seen["total"])
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns.

    Of rows that repeat a doc_id and a text one stays. Null and empty texts are no duplicates of each
    other; rows without a doc_id all stay. An empty table stays empty. Documents are joined with the
    few that go, which are hashed; they are not sorted or compared as a whole.
    """
    found = near_duplicates(docs).where("doc_id is not null").groupBy("doc_id")
    marks = found.agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n")).where("not kept or n > 1")
    marks, seen = measured(marks, "marks", repeated=F.count_if("kept"))
    gone, repeated = (marks.where(c).select("doc_id").hint("shuffle_hash") for c in ("not kept", "kept"))
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if not seen["repeated"]:
        return left
    once = left.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    several = left.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    return once.unionByName(several.dropDuplicates(["doc_id", "text"]))
