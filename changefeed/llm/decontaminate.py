"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.words import NO_WORD, RUN, U, mix, runs, text_words

# Masks of weight six: a window of words is hashed at the ones, and may differ at the zeros.
MASKS = ("111111", "11011011", "1100101011", "1010011011")
SHORTEST = 5
WHOLE = 17  # words of an item that is judged as a whole, not by its best stretch
# More masks for the windows of such items, by their words: with MASKS, some window is left whole wherever the words stand
# that four fifths of the item may differ in. Shapes are blocks of a partition, of which so many stay intact.
BLOCKS_OF_2 = ("11110011", "1111000011", "11001111", "1100110011", "1100001111")
BLOCKS_OF_3 = ("111000111", "111000000111", "111000000000111")
SHORT_MASKS = {
    5: ("1111", "11011", "10111", "11101"),
    6: ("1111", "110011"),
    7: ("1111", "110011"),
    8: ("11110011", "11001111"),
    9: ("111000111",),
    10: BLOCKS_OF_2,
    11: BLOCKS_OF_2,
    **dict.fromkeys((15, 16, 17), BLOCKS_OF_3),
}
PIECE_WORDS, PIECE_OVERLAP = 2048, 64
INDEX_WORDS = 1_000_000
ENOUGH_WORDS, SHARE = 13, 0.8
MISS = 2
FILTER_FACTOR = 16  # places of the quick filter per hash

MATCH = (
    "doc_id BIGINT, item_id BIGINT, doc_start BIGINT, doc_end BIGINT, item_start BIGINT, item_end BIGINT, n_equal BIGINT"
)


def word_hashes(texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """Lower-cased runs of letters and digits."""
    return text_words(((text or "").lower().encode("utf-8", "replace") for text in texts), NO_WORD)


def masked(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window under one mask."""
    n = max(0, len(words) - len(mask) + 1)
    total = np.full(n, U(len(mask)))
    for k, taken in enumerate(mask):
        if taken == "1":
            total += words[k : k + n] * RUN[k]
    return mix(total)


def before_each(hashes: np.ndarray) -> np.ndarray:
    """The hash before each; 0 before the first."""
    return np.concatenate([np.zeros(1, U), hashes[:-1]])[: len(hashes)]


@dataclass
class Index:
    """Hashes of benchmark pieces: one sorted array per mask, with where each hash stands and what stands before it.
    Items of under five words are found as a whole only, by one hash."""

    pieces: list[tuple[int | None, int, np.ndarray]]  # item, first word, hashes of its words
    masks: list[str] = field(default_factory=list)
    hashes: list[np.ndarray] = field(default_factory=list)
    owners: list[np.ndarray] = field(default_factory=list)
    places: list[np.ndarray] = field(default_factory=list)
    befores: list[np.ndarray] = field(default_factory=list)
    whole: dict[int, list[int | None]] = field(default_factory=dict)
    filters: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        for item, offset, words in self.pieces:
            if len(words) < SHORTEST and not offset:
                self.whole.setdefault(int(runs(words, SHORTEST)[0]), []).append(item)
        self.pieces = [piece for piece in self.pieces if len(piece[2]) >= SHORTEST]
        lengths = {len(words) for _, _, words in self.pieces}
        for mask in dict.fromkeys([*MASKS, *(m for n in sorted(lengths) for m in SHORT_MASKS.get(n, ()))]):
            taken = [mask in MASKS or mask in SHORT_MASKS.get(len(words), ()) for _, _, words in self.pieces]
            found = [masked(words if use else words[:0], mask) for use, (_, _, words) in zip(taken, self.pieces, strict=True)]
            hashes = np.concatenate([np.zeros(0, U), *found])
            order = np.argsort(hashes, kind="stable")
            sizes = [len(x) for x in found]
            self.masks.append(mask)
            self.hashes.append(hashes[order])
            self.owners.append(np.repeat(np.arange(len(found)), sizes)[order])
            self.places.append(np.concatenate([np.zeros(0, np.int64), *(np.arange(n) for n in sizes)])[order])
            self.befores.append(np.concatenate([np.zeros(0, U), *map(before_each, found)])[order])
            bits = max(10, int(FILTER_FACTOR * len(hashes)).bit_length())
            seen = np.zeros(1 << bits, bool)
            seen[hashes >> U(64 - bits)] = True
            self.filters.append(seen)

    def overlaps(self, words: np.ndarray) -> list[tuple[int | None, int, int, int, int, int]]:
        """(item, start and end in the text, start and end in the item, equal words) of one text.

        A window that agrees like the one before it lies on a diagonal that is known already. So of a stretch
        that repeats itself, in the text and in the item, only the ends are paired, not all with all.
        """
        if 0 < len(words) < SHORTEST:
            n = len(words)
            return [(item, 0, n, 0, n, n) for item in self.whole.get(int(runs(words, SHORTEST)[0]), ())]
        diagonals: set[tuple[int, int]] = set()
        for mask, hashes, owners, places, befores, seen in zip(
            self.masks, self.hashes, self.owners, self.places, self.befores, self.filters, strict=True
        ):
            windows = masked(words, mask)
            hits = np.flatnonzero(seen[windows >> U(65 - len(seen).bit_length())])
            low, high = (np.searchsorted(hashes, windows[hits], side) for side in ("left", "right"))
            hits, low, high = hits[high > low], low[high > low], high[high > low]
            before = before_each(windows)[hits] if len(hits) else windows[:0]
            # hits of one hash behind one other hash, together
            order = np.lexsort((before, low))
            hits, low, high, before = hits[order], low[order], high[order], before[order]
            fresh = np.append(True, (low[1:] != low[:-1]) | (before[1:] != before[:-1])) if len(hits) else np.zeros(0, bool)
            bounds = [*np.flatnonzero(fresh).tolist(), len(hits)]
            for first, last in zip(bounds, bounds[1:], strict=False):
                rows = np.arange(low[first], high[first])
                rows = rows[(befores[rows] != before[first]) | (befores[rows] == 0)]
                for at in hits[first:last].tolist() if len(rows) else ():
                    diagonals.update(zip(owners[rows].tolist(), (at - places[rows]).tolist(), strict=True))
        found = set()
        for owner, shift in diagonals:
            item, offset, piece = self.pieces[owner]
            for start, end, equal in aligned(words, piece, shift):
                found.add((item, start, end, offset + start - shift, offset + end - shift, equal))
        return sorted(found, key=lambda x: (x[0] is None, x[0] or 0, *x[1:]))


def aligned(words: np.ndarray, piece: np.ndarray, shift: int) -> Iterator[tuple[int, int, int]]:
    """The stretches of one diagonal that have enough equal words.

    A short item is judged as a whole, from its first equal word to its last. In a longer one equal words
    score one, others minus two: the best stretch is taken, then the best on either side of it.
    """
    low, high = max(0, shift), min(len(words), shift + len(piece))
    equal = words[low:high] == piece[low - shift : high - shift]
    enough = min(ENOUGH_WORDS, SHARE * len(piece))
    if len(piece) <= WHOLE:
        places = np.flatnonzero(equal)
        if len(places) and len(places) >= enough:
            yield low + int(places[0]), low + int(places[-1]) + 1, len(places)
        return
    open_parts = [(0, len(equal))]
    while open_parts:
        first, last = open_parts.pop()
        part = equal[first:last]
        if np.count_nonzero(part) < enough:
            continue
        run = np.concatenate([[0], np.cumsum(np.where(part, 1, -MISS))])
        end = int((run - np.minimum.accumulate(run)).argmax())
        start = int(run[: end + 1].argmin())
        n_equal = int(np.count_nonzero(part[start:end]))
        if n_equal >= enough:
            yield low + first + start, low + first + end, n_equal
        open_parts += [(first, first + start), (first + end, last)]


def benchmark_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items cut into overlapping pieces of bounded length."""
    for batch in batches:
        ids = batch.column("item_id").to_pylist()
        items, offsets, words = [], [], []
        for at, hashes in word_hashes(batch.column("text").to_pylist()):
            for start in range(0, max(1, len(hashes) - PIECE_OVERLAP), PIECE_WORDS - PIECE_OVERLAP):
                items.append(ids[at])
                offsets.append(start)
                words.append(hashes[start : start + PIECE_WORDS].astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(offsets, pa.int64()), pa.array(words, pa.list_(pa.int64()))],
            ["item_id", "offset", "words"],
        )


def indexes(benchmark: DataFrame, index_words: int = INDEX_WORDS) -> Iterator[Index]:
    """The benchmark in chunks of at most about `index_words` words, each small enough to send to every task.

    A benchmark beyond that is searched chunk by chunk: one pass over the documents for each.
    """
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    pieces = rows.mapInArrow(benchmark_pieces, "item_id BIGINT, offset BIGINT, words ARRAY<BIGINT>")
    pieces = pieces.where(F.size("words") > 0)
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    chunks = -(-total // index_words)
    chunk = F.pmod(F.xxhash64("item_id", "offset"), F.lit(max(1, chunks)))
    for k in range(chunks):
        yield Index([(r.item_id, r.offset, np.array(r.words, np.int64).astype(U)) for r in pieces.where(chunk == k).collect()])


def find_overlaps(docs: DataFrame, benchmark: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """(doc_id, item_id, doc_start, doc_end, item_start, item_end, n_equal): stretches of documents that hold
    benchmark text. docs: doc_id BIGINT, text STRING; benchmark: item_id BIGINT, text STRING; more ignored.

    Words are lower-cased runs of letters and digits, counted from 0, ends exclusive. Where a window
    of a document and one of an item agree under a mask, both are compared along that alignment. An item
    of up to 17 words counts if at least 13 of its words, or four fifths of a shorter one, are equal in
    their places, wherever the others stand. Of a longer item every stretch counts that has at least
    13 equal words, taken by the most equal words, less two for each other word.

    An item of under five words is found where a document consists of just these words. Null or empty
    texts hold nothing. Repeated rows give repeated results. A row without a doc_id is reported with a
    null. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], MATCH)
    for index in indexes(benchmark, index_words):
        found = found.unionByName(rows.mapInArrow(searcher(spark.sparkContext.broadcast(index)), MATCH))
    return found


def searcher(sent):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            ids, out = batch.column("doc_id").to_pylist(), []
            for at, words in word_hashes(batch.column("text").to_pylist()):
                out += [(ids[at], *match) for match in index.overlaps(words)]
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [p.split()[0] for p in MATCH.split(", ")])

    return search


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """The documents that hold no benchmark text, with all their columns. No join: each is judged where it is read.

    Documents with a null or empty text hold none and stay, repeated rows are judged alike, rows without a doc_id
    like any other. An empty table stays empty, and an empty benchmark leaves all documents.
    """

    def keeper(sent):
        def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                clean = np.ones(len(batch), bool)
                for at, words in word_hashes(batch.column("text").to_pylist()):
                    clean[at] = not index.overlaps(words)
                yield batch.filter(pa.array(clean))

        return keep

    for index in indexes(benchmark, index_words):
        docs = docs.mapInArrow(keeper(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return docs
