"""Fast similarity sketches of sets, and their bands.

Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching" (FOCS 2017): in each of the first t
rounds every element falls into one of t bins with a value that grows with the round; in the last
t rounds all elements fall into one given bin. So every bin is filled after at most 2t rounds,
nearly always after a few, and two sets agree in a bin with the probability of their Jaccard
similarity, as concentrated as with t independent hash functions.
"""

from __future__ import annotations

import numpy as np

from changefeed.llm.words import RUN, U, mix

EMPTY = np.iinfo(np.uint64).max
CHUNK = 1 << 20
AT_ONCE = 1 << 13
ROUND_SHIFT = U(54)
LOW = U((1 << 54) - 1)
SEEDS = np.random.default_rng(20240302).integers(1 << 63, size=2048, dtype=np.uint64)


def sketches(elements: np.ndarray, sizes: np.ndarray, bins: int) -> np.ndarray:
    """A row of `bins` values for each set; sets follow each other in `elements`. Empty sets stay EMPTY.

    Elements are mixed once; each round takes them times an odd number of its own.
    """
    out = np.full(len(sizes) * bins, EMPTY, U)
    table = out.reshape(len(sizes), bins)
    live = np.flatnonzero(sizes)  # sets with empty bins
    sizes = np.asarray(sizes)[live]
    row = np.repeat(live * bins, sizes)
    elements = mix(elements ^ SEEDS[0])
    turn = 0
    while len(live) and turn < 2 * bins:
        # a bin keeps the value of its earliest round, so several rounds of few elements can go at once
        end = min(turn + max(1, AT_ONCE // len(elements)), bins if turn < bins else 2 * bins)
        for at in range(0, len(elements), CHUNK):  # what is made on the way stays small, however large the sets
            # all bits are mixed, so an odd factor is enough to deal them anew
            hashed = elements[at : at + CHUNK] * (SEEDS[turn:end, None] | U(1))
            if turn < bins:
                place = hashed >> U(32)
                place *= U(bins)
                place >>= U(32)
                place = place.view(np.int64)
            else:
                place = np.repeat(np.arange(turn - bins, end - bins)[:, None], hashed.shape[1], axis=1)
            place += row[at : at + CHUNK]
            place, value, rounds = place.ravel(), hashed.ravel(), U(turn)
            if turn:  # bins filled in an earlier round hold less
                free = np.flatnonzero(out[place] >= rounds << ROUND_SHIFT)
                place, value = place[free], value[free]
                rounds += (free // hashed.shape[1]).astype(U)
            elif end > 1:
                rounds = np.repeat(np.arange(end, dtype=U), hashed.shape[1])
            value &= LOW
            value |= rounds << ROUND_SHIFT
            np.minimum.at(out, place, value)
        turn = end
        still = (table[live] == EMPTY).any(axis=1)
        if not still.all():
            keep = np.repeat(still, sizes)
            elements, row = elements[keep], row[keep]
            live, sizes = live[still], sizes[still]
    return table


def bands(table: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of `rows` bins; keys of different bands differ."""
    count = table.shape[1] // rows
    parts = table[:, : count * rows].reshape(len(table), count, rows)
    total = np.zeros((len(table), count), U)
    for k in range(rows):
        total += parts[:, :, k] * RUN[k]
    return mix(total ^ SEEDS[:count]).astype(np.int64)


def compact(table: np.ndarray) -> np.ndarray:
    """One byte per bin: enough to count agreeing bins, of which one in 256 agrees by chance."""
    return (mix(table) & U(255)).astype(np.uint8)
