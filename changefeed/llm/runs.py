"""Periodic runs of words, and texts with each run collapsed to one period.

Internal pattern matching (Kociumaka, Radoszewski, Rytter, Walen, "Internal Pattern Matching Queries
in a Text", 2015): in a run of length three times its period q, a dyadic block of L = 2^k words with
L <= q < 2L that starts in the run's first L words occurs again q words later. So

1. every aligned block asks for its occurrences in the windows to its right where such a q leads.
   Its occurrences are an interval of the suffix array; a wavelet tree over that array counts those
   in a window and gives the first, second and last by position (range successor);
2. occurrences in a window no longer than the block are one arithmetic progression. One or two are
   candidates as they stand. Of more, the block repeats with the progression's step, and a longer
   period must take the ends of that repetition onto each other: two candidates;
3. each candidate is extended to both sides by longest common extensions over the ranks that the
   suffix array was built from, which settles exactly whether it is a run.

Words are numbered per document, so a batch of documents is one text in which nothing occurs in two
documents. All steps are array operations over a batch of bounded size; a longer document is a batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.words import SPACES, U, mix, slices, text_words

LEAST_WORDS = 24
LEAST_PERIODS = 3
FIRST_LEVEL = 3  # blocks of eight words: a run of 24 words holds an aligned one and its next occurrence
BATCH_CHARS = 1 << 19

RUN = "STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>"
COLLAPSED = f"doc_id BIGINT, n_words BIGINT, runs ARRAY<{RUN}>, longest {RUN}, text STRING"


@dataclass
class Ranks:
    """levels[k][i]: the place in the suffix array where the suffixes begin that share the 2^k words at i;
    sizes[k][i]: how many they are. order: the suffix array."""

    levels: list[np.ndarray]
    sizes: list[np.ndarray]
    order: np.ndarray

    @classmethod
    def of(cls, symbols: np.ndarray) -> Ranks:
        """By doubling; suffixes whose words are unique already are not sorted again."""
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        kind = np.int32 if n < 1 << 31 else np.int64
        rank, size = np.zeros(n, kind), np.zeros(n, kind)

        def group(places: np.ndarray, fresh: np.ndarray) -> None:
            """Ranks of the suffixes at these places of the order, where `fresh` marks the first of each group."""
            heads = np.flatnonzero(fresh)
            counts = np.diff(np.append(heads, len(places)))
            rank[order[places]] = np.repeat(places[heads], counts)
            size[order[places]] = np.repeat(counts, counts)

        if n:
            ordered = symbols[order]
            group(np.arange(n), np.append(True, ordered[1:] != ordered[:-1]))
        levels, sizes, step = [rank.copy()], [size.copy()], 1
        while True:
            places = np.flatnonzero(size[order] > 1)
            if not len(places):
                break
            suffixes = order[places]
            own = rank[suffixes]
            beyond = suffixes + step
            behind = np.where(beyond < n, rank[np.minimum(beyond, n - 1)], -1)
            sort = np.lexsort((behind, own))
            order[places] = suffixes[sort]
            own, behind = own[sort], behind[sort]
            group(places, np.append(True, (own[1:] != own[:-1]) | (behind[1:] != behind[:-1])))
            levels.append(rank.copy())
            sizes.append(size.copy())
            step *= 2
        return cls(levels, sizes, order)

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal from a and from b on, pair by pair; a is not b."""
        a, b, n = a.copy(), b.copy(), len(self.order)
        begin = a.copy()
        for k in reversed(range(len(self.levels))):
            inside = np.maximum(a, b) < n
            same = inside & (self.levels[k][np.minimum(a, n - 1)] == self.levels[k][np.minimum(b, n - 1)])
            a, b = a + (same << k), b + (same << k)
        return a - begin

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal before a and before b."""
        a, b = a.copy(), b.copy()
        begin = a.copy()
        for k in reversed(range(len(self.levels))):
            inside = np.minimum(a, b) >= 1 << k
            at_a, at_b = np.where(inside, a - (1 << k), 0), np.where(inside, b - (1 << k), 0)
            same = inside & (self.levels[k][at_a] == self.levels[k][at_b])
            a, b = a - (same << k), b - (same << k)
        return begin - a


class WaveletTree:
    """Positions in the order of their suffixes, bit by bit from the highest; each level keeps counts of zeros."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in reversed(range(self.bits)):
            clear = (values >> bit & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(clear)]))
            values = np.concatenate([values[clear], values[~clear]])

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of values[left:right] are less than the bound."""
        found = np.where(bound >= 1 << self.bits, right - left, 0)
        bound = np.minimum(bound, (1 << self.bits) - 1)
        live = found == 0
        for level, bit in enumerate(reversed(range(self.bits))):
            zeros = self.zeros[level]
            one = (bound >> bit & 1) == 1
            low, high = zeros[left], zeros[right]
            found = found + np.where(live & one, high - low, 0)
            left = np.where(one, zeros[-1] + left - low, low)
            right = np.where(one, zeros[-1] + right - high, high)
        return found

    def smallest(self, left: np.ndarray, right: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value of values[left:right] that has `nth` smaller ones there; with `below`, the range successor."""
        value = np.zeros(len(left), np.int64)
        for level, bit in enumerate(reversed(range(self.bits))):
            zeros = self.zeros[level]
            low, high = zeros[left], zeros[right]
            one = nth >= high - low
            nth = np.where(one, nth - (high - low), nth)
            value |= one.astype(np.int64) << bit
            left = np.where(one, zeros[-1] + left - low, low)
            right = np.where(one, zeros[-1] + right - high, high)
        return value


def candidates(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(start of a block, candidate period) of all aligned blocks."""
    n = len(ranks.order)
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(ranks.levels) <= FIRST_LEVEL:
        return starts[0], periods[0]
    # the tree holds only suffixes whose first eight words occur again; others are no block's further occurrence
    again = ranks.sizes[FIRST_LEVEL][ranks.order] > 1
    tree = WaveletTree(ranks.order[again])
    compact = np.concatenate([[0], np.cumsum(again)])
    for k in range(FIRST_LEVEL, len(ranks.levels)):
        length = 1 << k
        block = np.arange(0, n, length, dtype=np.int64)
        block = block[ranks.sizes[k][block] > 1]
        if not len(block):
            continue
        left = compact[ranks.levels[k][block]]
        right = compact[ranks.levels[k][block] + ranks.sizes[k][block]]
        windows = [(1, length), (length, 2 * length)] if k == FIRST_LEVEL else [(length, 2 * length)]
        for low, high in windows:
            before = tree.below(left, right, block + low)
            count = tree.below(left, right, block + high) - before
            some = count > 0
            at, l, r, c, b = block[some], left[some], right[some], count[some], before[some]
            first = tree.smallest(l, r, b)
            second = tree.smallest(l, r, b + np.minimum(c, 2) - 1)
            few = c <= 2
            starts += [at, at[few]]
            periods += [first - at, (second - at)[few]]
            at, first, step = at[~few], first[~few], (second - first)[~few]
            if len(at):
                # how far the block's own repetition reaches, around the block and around its occurrences
                ends = [x + step + ranks.forward(x, x + step) for x in (at, first)]
                begins = [x - ranks.backward(x, x + step) for x in (at, first)]
                starts += [at, at]
                periods += [ends[1] - ends[0], begins[1] - begins[0]]
    start, period = np.concatenate(starts), np.concatenate(periods)
    fit = (period > 0) & (start + period < n)
    return start[fit], period[fit]


def find_runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs of at least 24 words and three periods, by start, then period."""
    ranks = Ranks.of(symbols)
    at, period = candidates(ranks)
    pairs = np.unique(np.stack([at, period]), axis=1) if len(at) else np.zeros((2, 0), np.int64)
    at, period = pairs
    if not len(at):
        return at, at, period
    start = at - ranks.backward(at, at + period)
    length = at + period + ranks.forward(at, at + period) - start
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, length, period = start[long], length[long], period[long]
    # of several periods of one stretch, the smallest: it divides the others
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[fresh], length[fresh], period[fresh]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def number_words(hashed: list[np.ndarray]) -> np.ndarray:
    """The words of several documents as one array of small numbers, no number in two documents."""
    tagged = [mix(words ^ mix(np.full(1, k + 1, U))) for k, words in enumerate(hashed)]
    flat = np.concatenate([np.zeros(0, U), *tagged])
    return np.unique(flat, return_inverse=True)[1]


def longest_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length over period; of equal ones the first, then that of the smallest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    keep = np.cumsum(dropped)[:-1] == 0
    return b" ".join(word for word, stay in zip(words, keep.tolist(), strict=True) if stay)


def collapse_batch(texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """(number of words, runs, collapsed text) of each text."""
    data = [(text or "").encode("utf-8", "replace") for text in texts]
    hashed = [words for _, words in text_words(data, SPACES)]
    bounds = np.cumsum([0, *map(len, hashed)])
    start, length, period = find_runs(number_words(hashed))
    places = np.searchsorted(start, bounds)
    for k, text in enumerate(data):
        rows = slice(places[k], places[k + 1])
        own = (start[rows] - bounds[k]).tolist()
        runs = list(zip(own, length[rows].tolist(), period[rows].tolist(), strict=True))
        yield len(hashed[k]), runs, kept_words(text.split(), runs).decode()


def collapse_arrow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def named(runs: list) -> list:
        return [None if r is None else dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]

    for batch in batches:
        done = 0
        for texts in slices(batch.column("text").to_pylist(), BATCH_CHARS):
            counts, runs, kept = zip(*collapse_batch(texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(done, len(texts)),
                    pa.array(counts, pa.int64()),
                    pa.array([named(r) for r in runs], pa.list_(run)),
                    pa.array(named([longest_of(r) for r in runs]), run),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_words", "runs", "longest", "text"],
            )
            done += len(texts)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, longest, text), one row per row of `docs` (doc_id BIGINT, text STRING, more ignored).

    Words are runs of anything but ASCII white space, numbered from 0; they are compared by 64-bit
    hashes. A run is a stretch of words with smallest period q (words q apart are equal) of at least
    24 words and three periods that no neighbouring word extends. runs: all of them, by start, then
    period. longest: the run of the greatest length over period; of equal ones the first, then that
    of the smallest period; null without a run. text: the words joined by one space, without those
    that some run holds after its first q words.

    A null, empty or wordless text has no words, no runs and an empty text. Rows that repeat, or
    have no doc_id, are each answered for themselves. An empty table gives no rows. A text is worked on as a
    whole, with eight bytes of memory a word for each doubling up to its longest repeat.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(collapse_arrow, COLLAPSED)
