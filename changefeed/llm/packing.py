"""Packing tokenized documents into training sequences by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
LEAST_CUT = 128
GROUP_WINDOWS = 128
FILL = 0.993
END_ID = b"\0\0\0\0"
TASK_SHIFT = 40

PIECE = (
    "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence_id BIGINT, offset BIGINT"
)


# Characters that every Unicode version puts into the same classes.
PLAIN = re.compile("[\n\x20-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+")


def encoder(ranks: str):
    """The same vocabulary in a faster library, for text of plain characters."""
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as file:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    return encoding.encode_ordinary


class Tokens:
    """Token ids of texts, as bytes."""

    def __init__(self, path: str, ranks: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.fast = encoder(ranks) if ranks else None

    def of(self, text: str) -> bytes:
        if not self.fast:
            return self.exact(text)
        if PLAIN.fullmatch(text):
            return array("I", self.fast(text)).tobytes()
        runs = groupby(separate(text), key=lambda piece: PLAIN.fullmatch(piece) is not None)
        return b"".join(
            array("I", self.fast("".join(run))).tobytes() if plain else self.exact("".join(run)) for plain, run in runs
        )

    def exact(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def separate(text: str) -> list[str]:
    """Pieces of a text, cut before every space that has no white space on either side: the
    tokenizer's first step never joins text across such a space, so pieces can be encoded alone."""
    parts = text.split(" ")
    if len(parts) == 1:
        return parts if text else []
    out = [parts[0]]
    for part in parts[1:]:
        last = out[-1]
        if not part or part[0].isspace() or not last or last[-1].isspace():
            out[-1] = f"{last} {part}"
        else:
            out.append(f" {part}")
    return out


def cuts(length: int) -> Iterator[int]:
    """Lengths of the pieces of a document: whole windows, then halves of a window down to 128, then the rest.

    Pieces of halving lengths difference to nothing, so little is left for the rest to balance.
    """
    size = WINDOW
    while length:
        if size < LEAST_CUT:
            yield length
            return
        while length >= size:
            yield size
            length -= size
        size //= 2


Slots = list[tuple[int, tuple[int, ...]]]


def differencing(sizes: list[int], windows: int) -> Slots:
    """Karmarkar-Karp: (sum, items) of each window in use. Every item begins as a partial partition with one
    window filled; the two partitions with the widest spread are merged, the fullest windows of
    one with the emptiest of the other, until one is left."""
    heap: list[tuple[int, int, Slots]] = [(-size, at, [(size, (at,))]) for at, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        (_, _, a), (_, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        free = windows - len(a)
        shared = max(0, len(b) - free)
        merged = a[: len(a) - shared] + b[: len(b) - shared]
        for (x, xs), (y, ys) in zip(a[len(a) - shared :], reversed(b[len(b) - shared :]), strict=True):
            merged.append((x + y, xs + ys))
        merged.sort(key=lambda slot: -slot[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, serial, merged))
        serial += 1
    return heap[0][2] if heap else []


def balanced(sizes: list[int], capacity: int = WINDOW) -> list[tuple[int, ...]]:
    """The items of each window: near-equal sums, none over capacity; one window more until that holds."""
    windows = -(-sum(sizes) // capacity)
    while True:
        slots = differencing(sizes, windows)
        if not slots or slots[0][0] <= capacity:
            return [items for _, items in slots]
        windows += 1


def packer(path: str, ranks: str | None, with_ids: bool):
    def pack_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path, ranks)
        sequence = TaskContext.get().partitionId() << TASK_SHIFT
        full: list[tuple] = []  # doc, start, ids, tokens of the document
        group: list[tuple] = []
        group_tokens = full_tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for piece in full:
                rows.append((piece, sequence, 0))
                sequence += 1
            for window in balanced([len(ids) // 4 for _, _, ids, _ in group]):
                offset = 0
                for at in sorted(window):
                    rows.append((group[at], sequence, offset))
                    offset += len(group[at][2]) // 4
                sequence += 1
            return piece_rows(rows, with_ids)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = tokens.of(text or "") + END_ID
                total, start = len(ids) // 4, 0
                for length in cuts(total):
                    piece = (doc_id, start, ids[4 * start : 4 * (start + length)], total)
                    start += length
                    if length == WINDOW:
                        full.append(piece)
                        full_tokens += length
                    else:
                        group.append(piece)
                        group_tokens += length
                if group_tokens >= FILL * WINDOW * GROUP_WINDOWS or full_tokens >= 8 * WINDOW * GROUP_WINDOWS:
                    if group_tokens >= FILL * WINDOW * GROUP_WINDOWS:
                        yield flush()
                        group, group_tokens = [], 0
                    else:
                        kept, group = group, []
                        yield flush()
                        group = kept
                    full, full_tokens = [], 0
        yield flush()

    return pack_task


def piece_rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    ints = lambda values: pa.array(values, pa.int64())
    columns = {
        "doc_id": ints([p[0] for p, _, _ in rows]),
        "start": ints([p[1] for p, _, _ in rows]),
        "length": ints([len(p[2]) // 4 for p, _, _ in rows]),
        "ids_crc32": ints([zlib.crc32(p[2]) for p, _, _ in rows]),
        "doc_tokens": ints([p[3] for p, _, _ in rows]),
        "sequence_id": ints([s for _, s, _ in rows]),
        "offset": ints([o for _, _, o in rows]),
    }
    if with_ids:
        values = np.frombuffer(b"".join(p[2] for p, _, _ in rows), "<u4").astype(np.int32)
        ends = np.cumsum([0, *(len(p[2]) // 4 for p, _, _ in rows)]).astype(np.int32)
        columns["ids"] = pa.ListArray.from_arrays(ends, values)
    return pa.RecordBatch.from_pydict(columns)


def pack(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), one row per piece of a document.

    docs: doc_id BIGINT, text STRING; more columns are ignored. Each document is its token ids and
    an id 0. Whole windows of 1,024 ids are sequences of their own; what remains is cut and packed,
    some 128 windows at a time, into windows of near-equal load, one more whenever one would overflow.
    Every task packs its own rows as they come, so nothing is shuffled or gathered, and a task that
    is run again on the same rows gives the same sequences. sequence_id: task number * 2^40 + count.

    A null or empty text is the id 0 alone. Repeated rows are packed each; a null doc_id stays
    null. Long texts give many pieces. An empty table gives no rows. `tokenizer` is the path of a
    tokenizer file that all executors can read, `ranks` that of the same vocabulary as a rank file,
    which only makes it faster; by default the installed byte-level one.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(packer(tokenizer, ranks, with_ids), PIECE + (", ids ARRAY<INT>" if with_ids else ""))
