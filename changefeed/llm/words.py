"""Hashes of words and of word runs, for many texts at once.

A word's hash is a polynomial over its bytes, taken from running sums, so that a batch of texts
costs a few passes over one byte array and no Python per word. Texts are cut into segments at
word ends; memory follows the segment, not the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SEGMENT_BYTES = 1 << 20
PIECE_CHARS = 1 << 16  # what is worked out of a piece stays in a core's cache

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
RUN = np.random.default_rng(20240229).integers(1 << 62, size=64, dtype=np.uint64) * U(2) + U(1)
BYTE = np.random.default_rng(20240301).integers(1 << 63, size=256, dtype=np.uint64) * U(2) + U(1)

# Byte classes. The first splits on ASCII white space, the second on ASCII that is no letter or digit.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NO_WORD = bytes(b for b in range(0x80) if not chr(b).isalnum())

_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def powers(name: str, base: np.uint64, length: int) -> np.ndarray:
    if len(_powers[name]) < length:
        run = np.full(max(length, SEGMENT_BYTES + 4096), base, U)
        run[0] = 1
        _powers[name] = np.cumprod(run, dtype=U)
    return _powers[name][:length]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def breaks_table(separators: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


def segment_words(data: bytes, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends (byte offsets) of the words of one segment."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.empty(len(raw) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(breaks[raw], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum(BYTE[raw] * powers("up", BASE, len(raw)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers("down", BASE_INVERSE, len(raw) + 1)[starts]
    return mix(hashes ^ (ends - starts).astype(U)), starts, ends


def cut(data: bytes, breaks: np.ndarray, size: int) -> Iterator[bytes]:
    """Pieces of about `size` bytes that split no word."""
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data) and not breaks[data[end]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def text_words(texts: Iterable[bytes], separators: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the text, hashes of all its words in order), one per text."""
    breaks = breaks_table(separators)
    glue = separators[:1]
    batch: list[bytes] = []
    first = filled = 0

    def flush():
        lengths = np.fromiter((len(t) + 1 for t in batch), np.int64, len(batch))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        hashes, starts, _ = segment_words(glue.join(batch), breaks)
        places = np.searchsorted(starts, bounds)
        for k in range(len(batch)):
            yield first + k, hashes[places[k] : places[k + 1]]

    for index, text in enumerate(texts):
        if len(text) > SEGMENT_BYTES:
            yield from flush() if batch else ()
            parts = [segment_words(piece, breaks)[0] for piece in cut(text, breaks, SEGMENT_BYTES)]
            yield index, np.concatenate(parts)
            batch, first, filled = [], index + 1, 0
            continue
        batch.append(text)
        filled += len(text) + 1
        if filled > SEGMENT_BYTES:
            yield from flush()
            batch, first, filled = [], index + 1, 0
    if batch:
        yield from flush()


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of `length` words; a shorter text is one run of what it has."""
    if 0 < len(hashes) < length:
        return mix((hashes * RUN[: len(hashes)]).sum(keepdims=True, dtype=U) + U(len(hashes)))
    n = max(0, len(hashes) - length + 1)
    total = np.zeros(n, U)
    for k in range(length):
        total += hashes[k : k + n] * RUN[k]
    return mix(total)


def ascii_lower(text: str | None) -> bytes:
    """UTF-8 with A to Z lowered; lone surrogates, which no table holds, would be replaced."""
    return (text or "").encode("utf-8", "replace").lower()


def character_runs(texts: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `length` characters of each text, one text after the other, and how
    many each text has; a shorter text that is not empty is one run. Long texts go in pieces."""
    flat, sizes = [np.zeros(0, U)], np.zeros(len(texts), np.int64)
    pieces: list[tuple[int, str]] = []
    filled = 0

    def flush() -> None:
        hashes, counts = piece_runs([piece for _, piece in pieces], length)
        flat.append(hashes)
        np.add.at(sizes, [owner for owner, _ in pieces], counts)

    for owner, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE_CHARS):
            pieces.append((owner, text[at : at + PIECE_CHARS + length - 1]))
            filled += len(pieces[-1][1])
            if filled > PIECE_CHARS:
                flush()
                pieces, filled = [], 0
    if pieces:
        flush()
    return np.concatenate(flat), sizes


def piece_runs(texts: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products, not mixed: their upper bits depend on the whole run, their lower ones on the characters' lower ones."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(U)
    n = max(0, len(points) - length + 1)
    total, done = np.zeros(n, U), 0
    span, width = points, 1  # sums over 1, 2, 4 and so on places, each of two shorter ones
    while width <= length:
        if length & width:
            total += span[done : done + n] * RUN[-1 - done.bit_length()]
            done += width
        if 2 * width <= length:
            span = span[:-width] + span[width:] * RUN[width.bit_length()]
        width *= 2
    counts = np.maximum(lengths - length + 1, 0)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    within = np.ones(len(points), bool)  # whether the run from a place on lies within one text
    for k in range(1, length):
        within[ends[ends >= k] - k] = False
    found = total[within[:n]]
    short = np.flatnonzero((lengths > 0) & (lengths < length))
    if len(short):
        whole = [(points[starts[k] : starts[k] + lengths[k]] * RUN[: lengths[k]]).sum(dtype=U) for k in short]
        found = np.insert(found, (np.cumsum(counts) - counts)[short], np.array(whole, U))
        counts[short] = 1
    return found, counts


def slices(texts: list[str | None], size: int = SEGMENT_BYTES) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about `size` characters or one longer text."""
    part: list[str | None] = []
    filled = 0
    for text in texts:
        part.append(text)
        filled += len(text or "") + 1
        if filled >= size:
            yield part
            part, filled = [], 0
    if part:
        yield part
