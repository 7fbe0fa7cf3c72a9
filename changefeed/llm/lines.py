"""Fuzzy line deduplication over character shingles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.components import free_name, join_spread, measured, stored
from changefeed.llm.near import KEYS_HELD, PACKED, Likeness, bucket_components, key_parts, packed, packed_members
from changefeed.llm.words import character_runs
from changefeed.llm.workers import tidy

SHINGLE_CHARS = 8
PERCENT = 80
BINS, ROWS = 80, 4  # 20 bands: a pair at the threshold is missed 3 times in 100,000
TRIM = " \t\r\x0b\x0c"


def line_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return character_runs([text or "" for text in texts], SHINGLE_CHARS)


LIKENESS = Likeness(line_sets, BINS, ROWS, PERCENT)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, body, id) of lines that are not blank; the id is a hash of the trimmed line."""
    exploded = docs.where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # trimming goes over a whole line for each of its uses, so it is left to lines that have something to lose
    edges = [edge("line", F.lit(char)) for char in TRIM for edge in (F.startswith, F.endswith)]
    body = F.when(reduce(Column.__or__, edges), F.btrim("line", F.lit(TRIM))).otherwise(F.col("line"))
    bodies = exploded.select("doc_id", "line_no", body.alias("body"))
    return bodies.where("body <> ''").withColumn("id", F.xxhash64("body"))


def line_keys(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Ids and keys of every band, packed for so many parts; a line repeated in a task is taken once."""
    seen: set[int] = set()
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        ids, fresh = batch.column("id").to_pylist(), []
        for at, line in enumerate(ids):
            if line not in seen:
                seen.add(line)
                fresh.append(at)
        if not fresh:
            continue
        bodies = batch.column("body").take(pa.array(fresh)).to_pylist()
        keys = LIKENESS.keys(bodies)
        named = np.repeat(np.array([ids[at] for at in fresh], np.int64), keys.shape[1])
        held.append((named, keys.ravel()))
        if sum(len(ids) for ids, _ in held) >= KEYS_HELD:
            yield packed(*map(np.concatenate, zip(*held, strict=True)), parts)
            held = []
    if held:
        yield packed(*map(np.concatenate, zip(*held, strict=True)), parts)


def extract_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) of the lines wanted of each document."""
    for batch in batches:
        ids, texts = [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            lines = (text or "").split("\n")
            for place in wanted:
                if place["line_no"] < len(lines):
                    ids.append(place["id"])
                    texts.append(lines[place["line_no"]].strip(TRIM))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["id", "text"])


def line_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, kept_doc_id, kept_line_no, kept), one row per line of `docs` (doc_id BIGINT, text STRING, more ignored).

    Lines are split at line feeds, numbered from 0 and trimmed of white space. Two lines are linked
    if they are equal or if their sets of 8-character runs have a Jaccard similarity of 0.8 or
    more; a line of under eight characters is one run, so it is linked with equal lines only. Each
    component keeps its first line by (doc_id, line_no).

    Blank lines are left alone and not listed, as are all lines of null or empty texts and of rows
    without a doc_id. Rows that repeat a doc_id list their lines again; a line at the kept place is
    kept each time. An empty table gives no rows.

    Equal lines are grouped by a 64-bit hash before anything else, within each task already for the
    band keys, so a line in a third of all documents costs a few rows per task; where lines get their
    keeper, such a line's rows stay spread.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = lines_of(rows)
    places = stored(lines.select("doc_id", "line_no", "id"), "places")
    grouped = places.groupBy("id").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n"))
    first, seen = measured(grouped, "lines", total=F.sum("n"))
    parts = key_parts(docs.sparkSession, (seen["total"] or 0) * BINS // ROWS)
    bodies = lines.where(F.length("body") >= SHINGLE_CHARS).select("id", "body")
    keys = bodies.mapInArrow(tidy(partial(line_keys, parts=parts)), PACKED)

    def fetch(ids: DataFrame) -> DataFrame:
        places = first.join(ids, "id").select("first.doc_id", F.struct("first.line_no", "id").alias("place"))
        wanted = places.groupBy("doc_id").agg(F.collect_list("place").alias("wanted"))
        found = rows.join(wanted.hint("shuffle_hash"), "doc_id").select("text", "wanted")
        texts = found.mapInArrow(tidy(extract_lines), "id BIGINT, text STRING")
        return texts.where(F.xxhash64("text") == F.col("id")).distinct()

    components = bucket_components(packed_members(keys, parts), fetch, LIKENESS).withColumnRenamed("node", "id")
    linked = first.join(components, "id")
    keepers = linked.groupBy("component").agg(F.min("first").alias("keeper"))
    keeper_of = linked.join(keepers, "component").select("id", "n", "keeper")
    copied = first.where("n > 1").join(components, "id", "left_anti").select("id", "n", F.col("first").alias("keeper"))
    # a line that stands once and has no link is its own keeper, and joined with nothing
    placed = join_spread(places, keeper_of.unionByName(copied), ["id"], seen["total"] or 0)
    own = F.struct("doc_id", "line_no")
    kept = placed.select("doc_id", "line_no", F.coalesce("keeper", own).alias("keeper"))
    return kept.select(
        "doc_id",
        "line_no",
        F.col("keeper.doc_id").alias("kept_doc_id"),
        F.col("keeper.line_no").alias("kept_line_no"),
        (own == F.col("keeper")).alias("kept"),
    )


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents without the lines that are not kept; `n_chars`, if there, is counted anew.

    A document that had lines to lose and has no text left is gone: all of it stands elsewhere.
    Documents with a null, empty or blank text, and rows without a doc_id, stay as they are. Rows that
    repeat a doc_id lose the lines of any of them at the same place. An empty table stays empty.
    """
    gone_of = free_name(docs, "gone_lines")
    gone = line_classes(docs).where("not kept").groupBy("doc_id").agg(F.collect_set("line_no").alias(gone_of))
    columns = docs.columns
    # the small side is hashed, so that whole documents are neither sorted nor held
    together = docs.join(gone.hint("shuffle_hash"), "doc_id", "left")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            gone_lines = batch.column(gone_of).to_pylist()
            for text, places in zip(batch.column("text").to_pylist(), gone_lines, strict=True):
                if places and text is not None:
                    drop = set(places)
                    text = "\n".join(line for at, line in enumerate(text.split("\n")) if at not in drop)
                    text = text if text.strip() else None
                texts.append(text)
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, "text", pa.array(texts, pa.string()))
            lost = np.array([bool(g) and t is None for g, t in zip(gone_lines, texts, strict=True)], bool)
            yield batch.filter(pa.array(~lost)).select(columns)

    left = together.select(*columns, gone_of).mapInArrow(tidy(cut), docs.schema)
    return left.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in columns else left
