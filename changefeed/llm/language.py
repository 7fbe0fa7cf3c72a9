"""Language identification by rank-order profiles of character n-grams.

Cavnar and Trenkle, "N-Gram-Based Text Categorization" (1994): a language's profile lists its most
frequent n-grams by rank; a document is in the language whose profile puts the document's own most
frequent n-grams least out of place.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.components import measured, stored

PROFILE = 400  # n-grams in a profile, of a language and of a document
LANGUAGES = 1_000  # languages whose profiles are sent to the tasks at a time
PIECE_CHARS = 1 << 20
BITS = np.uint64(21)
SPACE = np.uint64(32)
UNKNOWN = "und"


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)


def pieces(text: str) -> Iterator[str]:
    """Parts of bounded length, cut at white space where there is any."""
    at = 0
    while at < len(text):
        end = at + PIECE_CHARS
        if end < len(text):
            end = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end)) + 1 or end
        yield text[at:end]
        at = end


def piece_ngrams(text: str) -> np.ndarray:
    """Codes of all runs of one to three letters; a word's first and last letters also go with the space beside them."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.where(letters()[points], points, 32).astype(np.uint64)
    points = points[(points != SPACE) | np.concatenate([[True], points[:-1] != SPACE])]
    if len(points) < 3:
        return np.zeros(0, np.uint64)
    a, b, c = points[:-2], points[1:-1], points[2:]
    single = points[points != SPACE]
    pairs = (points[:-1] << BITS) | points[1:]
    triples = ((a << BITS | b) << BITS | c)[b != SPACE]
    return np.concatenate([single, pairs, triples])


def count_ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text, in order of their codes, and how often each occurs."""
    parts = [np.unique(piece_ngrams(part), return_counts=True) for part in pieces(text)]
    if len(parts) == 1:
        return parts[0]
    return merge(parts)


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([np.zeros(0, np.uint64), *(c for c, _ in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)])
    distinct, place = np.unique(codes, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, counts)
    return distinct, total


def ranked(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, the first one first; ties by code."""
    return codes[np.argsort(-counts, kind="stable")[:PROFILE]]


@dataclass(frozen=True)
class Profiles:
    """Per language its n-grams in order of code, with the rank of each."""

    names: tuple[str, ...]
    codes: tuple[np.ndarray, ...]
    ranks: tuple[np.ndarray, ...]

    def nearest(self, text: str | None, known: tuple[str | None, int, int]) -> tuple[str | None, int, int]:
        """(language, its distance, that of the next one) among these languages and what is known of others."""
        own = ranked(*count_ngrams(text or ""))
        if not len(own):
            return known
        best, least, rest = known
        for k, name in enumerate(self.names):
            apart = self.distance(own, k)
            if best is None or (apart, name) < (least, best):
                best, least, rest = name, apart, least if best is not None else PROFILE * len(own)
            else:
                rest = min(rest, apart)
        return best, least, rest

    def distance(self, own: np.ndarray, k: int) -> int:
        """Ranks out of place, summed; an n-gram the language's profile lacks counts as far as any can."""
        codes, ranks = self.codes[k], self.ranks[k]
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        apart = np.abs(ranks[at] - np.arange(len(own)))
        return int(np.where(codes[at] == own, apart, PROFILE).sum())


def language_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n) of one task."""
    totals: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        by_language: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_language.setdefault(lang, []).append(text or "")
        for lang, texts in by_language.items():
            totals[lang] = [merge([*totals.get(lang, []), count_ngrams("\n".join(texts))])]
    for lang, [(codes, counts)] in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts)],
            ["lang", "code", "n"],
        )


@dataclass(frozen=True)
class Fitted:
    """(lang, code, rank, part) of all languages, stored: their n-grams, in so many parts of about LANGUAGES."""

    table: DataFrame
    parts: int

    def profiles(self) -> Iterator[Profiles]:
        """One part after another, each small enough to be sent to every task."""
        for part in range(self.parts):
            found: dict[str, list[tuple[int, int]]] = {}
            for row in self.table.where(F.col("part") == part).select("lang", "code", "rank").collect():
                found.setdefault(row.lang, []).append((row.code, row.rank))
            names = sorted(found)
            tables = [np.array(sorted(found[name]), np.int64) for name in names]
            yield Profiles(tuple(names), tuple(t[:, 0].astype(np.uint64) for t in tables), tuple(t[:, 1] for t in tables))


def fit(docs: DataFrame, use: Column) -> Fitted:
    """Profiles of every language, from text and lang of the rows where `use` holds and lang is not null, all of them.

    N-grams are counted in every task, summed, and cut to each language's most frequent ones, in
    every task before they meet. Languages without a letter in any text have no profile.
    """
    rows = docs.where(use).where("lang is not null")
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(language_counts, "lang STRING, code BIGINT, n BIGINT")
    counted = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PROFILE)
    best, seen = measured(best.select("lang", "code", (F.col("place") - 1).alias("rank"), "place"), "profiles", languages=F.count_if(F.col("place") == 1))
    parts = -(-(seen["languages"] or 0) // LANGUAGES)
    return Fitted(best.withColumn("part", F.pmod(F.xxhash64("lang"), F.lit(max(1, parts)))), parts)


def predict(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of `docs` (doc_id BIGINT, text STRING, more ignored).

    The score is how far, between 0 and 1, the least distance lies below the next. Whole texts are
    counted, long ones in parts. A null text, one without a letter, or no profile at all gives "und" with
    score 0. Of languages at the same distance the first by name is given. Repeated rows and rows without a
    doc_id are judged like any other. An empty table gives no rows. Beyond LANGUAGES languages the texts are
    compared with one part of them after another, and stored in between with the nearest one so far.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lit(None).cast("string").alias("best"),
        F.lit(0).cast("bigint").alias("least"),
        F.lit(0).cast("bigint").alias("rest"),
    )
    for part, profiles in enumerate(fitted.profiles()):
        rows = stored(rows, "compared") if part else rows
        rows = rows.mapInArrow(comparing(profiles, part == fitted.parts - 1), "doc_id BIGINT, text STRING, best STRING, least BIGINT, rest BIGINT")
    score = F.when(F.col("rest") > 0, (F.col("rest") - F.col("least")) / F.col("rest")).otherwise(0.0)
    return rows.select("doc_id", F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))


def comparing(profiles: Profiles, last: bool):
    """Each text against these profiles; texts are not handed on behind the last ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = zip(*(batch.column(name).to_pylist() for name in ("best", "least", "rest")), strict=True)
            found = [profiles.nearest(text, so_far) for text, so_far in zip(batch.column("text").to_pylist(), known, strict=True)]
            best, least, rest = zip(*found, strict=True) if found else ((), (), ())
            text = pa.nulls(len(batch), pa.string()) if last else batch.column("text")
            columns = [batch.column("doc_id"), text, pa.array(best, pa.string()), pa.array(least, pa.int64()), pa.array(rest, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "best", "least", "rest"])

    return run
