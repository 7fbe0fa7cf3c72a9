"""How filters act together: what each removes in any order, and its Shapley share.

Which filters a document fails is one small number. Counts of these per part of the corpus give
what every coalition of filters removes; all that the audit reports follows from those, whatever
the order of the filters:

* A step removes what its coalition removes beyond the coalition before it.
* The Shapley shares are the solution of a least squares problem over the coalitions (Charnes et
  al., 1988; Lundberg and Lee, 2017): the weighted sum of (removed(S) - sum of shares in S)^2 is
  least, subject to the shares adding up to what all filters remove. Its normal equations, with a
  multiplier for the constraint, are solved in rationals, so the shares are exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.components import stored

FILTERS = "ABCDE"
FEW_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = re.compile(rb"[#$%&*|]")
COPY = 1 << FILTERS.index("E")
MEASURES = ["removed", "good", "toxic"]

PROFILE = "doc_id BIGINT, part STRING, digest BINARY, failed INT"
STEPS = (
    "part STRING, filter_order STRING, step INT, kept BIGINT, removed BIGINT, redundant BIGINT, unique_fails BIGINT, "
    "good_lost BIGINT, toxic_lost BIGINT, shapley BIGINT"
)


def failures(text: str) -> int:
    """Bits of the filters A to D that a text fails. Words are runs of anything but ASCII white space."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    failed = [
        len(words) < FEW_WORDS,
        100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * (len(data) - len(data.translate(None, UPPER))) > UPPER_PERCENT * len(text),
        SYMBOLS.search(data) is not None,
    ]
    return sum(1 << k for k, bad in enumerate(failed) if bad)


def profiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [text or "" for text in batch.column("text").to_pylist()]
        digests = [hashlib.sha256(text.encode("utf-8", "replace")).digest() for text in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(map(failures, texts), pa.int32())],
            ["doc_id", "part", "digest", "failed"],
        )


def failed_filters(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed), one row per row of `docs`: bits of the filters that its text fails.

    Filter E asks for an equal text under a smaller doc_id anywhere in the table. Texts meet by their
    SHA-256; a digest's smallest doc_id is sent back to that document alone, so copies of one text,
    however many, are combined in each task and never gathered.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    profile = stored(rows.mapInArrow(profiles, PROFILE), "failures")
    first = profile.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copied = profile.join(first, ["doc_id", "digest"], "left")
    is_copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return copied.select("doc_id", "part", (F.col("failed") + F.when(is_copy, COPY).otherwise(0)).alias("failed"))


def coalition_inputs(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, removed, good, toxic): documents per part and set of failed filters, at most 32 rows per part."""
    label = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = failed.join(label, "doc_id", "left")
    return marked.groupBy("part", "failed").agg(
        F.count("*").alias("removed"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in MEASURES[1:])
    )


def tabulate(cells: np.ndarray) -> np.ndarray:
    """What each coalition removes, from counts by set of failed filters: both indexed by bits, any trailing columns."""
    sets = np.arange(len(cells))
    return (((sets[:, None] & sets[None, :]) != 0).astype(np.int64)) @ cells


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """Gauss-Jordan elimination in rationals; several right-hand sides."""
    rows = [a + b for a, b in zip(matrix, right, strict=True)]
    n = len(matrix)
    for k in range(n):
        pivot = next(i for i in range(k, n) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(n):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k], strict=True)]
    return [row[n:] for row in rows]


def shapley_weights(n: int) -> list[list[Fraction]]:
    """Row i gives filter i's Shapley share as a sum over coalitions, weighted by these rationals.

    Normal equations of the least squares problem: for each i, the sum over proper, non-empty
    coalitions S that hold i of w(S) * (sum of shares in S) plus a multiplier equals the sum of
    w(S) * removed(S); the shares add up to removed(all). One right-hand side per coalition.
    """
    if n == 1:
        return [[Fraction(0), Fraction(1)]]
    full = (1 << n) - 1
    kernel = {s: Fraction(n - 1, comb(n, k := s.bit_count()) * k * (n - k)) for s in range(1, full)}
    matrix = [[sum((w for s, w in kernel.items() if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    matrix.append([Fraction(1)] * n + [Fraction(0)])
    right = [[kernel.get(s, Fraction(0)) if s >> i & 1 else Fraction(0) for s in range(full + 1)] for i in range(n)]
    right.append([Fraction(int(s == full)) for s in range(full + 1)])
    return solve(matrix, right)[:n]


def step_table(filters: Sequence[str]) -> tuple[list[tuple[str, int]], np.ndarray, np.ndarray, np.ndarray]:
    """Names of all steps of all orders, and for each its filter and the coalitions before and after it."""
    names, which, before, after = [], [], [], []
    for order in permutations(range(len(filters))):
        done = 0
        for step, k in enumerate(order, 1):
            names.append(("".join(filters[i] for i in order), step))
            which.append(k)
            before.append(done)
            done |= 1 << k
            after.append(done)
    return names, np.array(which), np.array(before), np.array(after)


def steps_of(filters: Sequence[str]):
    n = len(filters)
    orders = factorial(n)

    def steps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, which, before, after = step_table(filters)
        weights = shapley_weights(n)
        one, full = 1 << which, (1 << n) - 1
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                counts = np.zeros((1 << n, len(MEASURES)), np.int64)
                for cell in cells:
                    counts[cell["failed"]] = [cell[measure] for measure in MEASURES]
                removed, good, toxic = tabulate(counts).T
                shares = [sum(w * int(v) for w, v in zip(row, removed, strict=True)) * orders for row in weights]
                if any(share.denominator != 1 for share in shares):
                    raise ArithmeticError(f"shares of {part!r} are no whole numbers over all orders")
                here = removed[after] - removed[before]
                columns = [
                    pa.array([part] * len(names), pa.string()),
                    pa.array([order for order, _ in names]),
                    pa.array([step for _, step in names], pa.int32()),
                    pa.array(counts[:, 0].sum() - removed[after]),
                    pa.array(here),
                    pa.array(removed[one] - here),
                    pa.array(removed[full] - removed[full ^ one]),
                    pa.array(good[after] - good[before]),
                    pa.array(toxic[after] - toxic[before]),
                    pa.array(np.array([int(share) for share in shares])[which]),
                ]
                yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in STEPS.split(", ")])

    return steps


def audit_failures(inputs: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """All steps of all orders from (part, failed, removed, good, toxic), one row per part and set of failed filters."""
    cells = inputs.groupBy("part").agg(F.collect_list(F.struct("failed", *MEASURES)).alias("cells"))
    return cells.mapInArrow(steps_of(filters), STEPS)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (lang), order of the filters A to E and step, as the steps of `STEPS`.

    docs: doc_id BIGINT, text STRING, lang STRING, more ignored. labels: doc_id, quality, toxic.
    A fails under 200 words, B under 50 % distinct words, C over 3 % capital letters, D with any of
    #$%&*|, E if a smaller doc_id has an equal text. kept, removed: after and at this step.
    redundant: fail its filter but were removed earlier. unique_fails: fail its filter only.
    good_lost, toxic_lost: removed here and labelled so. shapley: what its filter removes, added
    over all orders, that is the number of orders times its Shapley share.

    A null text is empty, a null lang the part ''. Every row counts, repeated ones too: rows that
    share doc_id and text are all first or all copies. A row without a doc_id is no copy and makes
    none. A document with several labels has what any of them says; one without has neither. Parts
    have rows for all steps, zeros included; an empty table gives no rows.
    """
    return audit_failures(coalition_inputs(failed_filters(docs), labels))
