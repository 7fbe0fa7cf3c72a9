"""Quality rules: simple counts, and perplexity under a language model of the corpus itself.

The model is an interpolated modified Kneser-Ney model (Chen and Goodman, 1998) of runs of five
characters, one per language, whose counts Spark takes over all documents. It grows with the corpus
and is sent nowhere as a whole:

1. `corpus_grams` counts the distinct runs of every input file, its block, and stores them.
2. `levels_of` adds them up per language and derives the continuation counts of shorter runs.
3. `gram_bits` gives the bits of every run asked for, by joins along the chain of shorter runs;
   runs that the model lacks back off.
4. `write_arrays` stores for each block its own runs, as one array of hashes in ascending order and
   one of bits. A task that scores documents of a file opens that file's arrays and searches them.

So no shuffle carries text, and rows between tasks follow the distinct runs of files, not their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.components import stored
from changefeed.llm.words import RUN, SPACES, U, mix, runs, slices, text_words
from changefeed.session import scratch_table

ORDER = 5
COUNT_CHARS = 1 << 22
SCORE_CHARS = 1 << 17  # small enough for a core's cache
WHITE = " \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
DIGITS = bytes.maketrans(b"123456789", b"000000000")

LEAST_WORDS = 50
REPEAT_PERCENT = 50
REPEAT_WORDS = 3

# A band reaches from the median by so many times the distance to the quantile of 16 or 84 %, which is one
# standard deviation of normal values, and that distance counts as a twentieth of a bit at least.
LOWER_WIDTH = 4
UPPER_WIDTH = 4
LEAST_SPREAD = 0.05
PRECISION = 1000  # quantiles are exact over thousandths of a bit

MISSING = "a document holds runs that its file did not have when they were counted"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCORED = "doc_id BIGINT, lang STRING, " + ", ".join(f"{c} BIGINT" for c in COUNTS) + ", n_grams BIGINT, bits DOUBLE"


# -- counts of one text --------------------------------------------------------------------


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    count = 0
    for line in text.split("\n") if "\n" in text else ():
        if line in seen:
            count += 1
        elif line.strip(WHITE):
            seen.add(line)
    return count


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) <= REPEAT_WORDS:
        return 0
    windows = runs(words, REPEAT_WORDS)
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(REPEAT_WORDS):
        covered[again + k] = True
    return int(covered.sum())


def text_counts(texts: list[str]) -> list[list[int]]:
    """The columns of COUNTS."""
    data = [text.encode("utf-8", "replace") for text in texts]
    rows = []
    for k, words in text_words(data, SPACES):
        text = texts[k]
        white = sum(text.count(c) for c in WHITE)
        symbols = len(data[k]) - len(data[k].translate(None, SYMBOLS))
        rows.append((len(words), len(text) - white, symbols, repeated_lines(text), repeated_words(words)))
    return [list(column) for column in zip(*rows, strict=True)] or [[] for _ in COUNTS]


# -- runs of characters --------------------------------------------------------------------


def plain(text: str | None) -> str:
    """As the model reads it: lower case, digits as 0, words joined by one space."""
    return b" ".join((text or "").encode("utf-8", "replace").translate(DIGITS).split()).decode().lower()


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts in a row, where a run of ORDER of them begins within one text, and how many do in each."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(lengths - ORDER + 1, 0)
    places = np.arange(counts.sum()) + np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(counts) - counts), counts)
    return points, places, counts


def distinct_grams(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct runs of ORDER characters and how often each occurs. While the letters allow it a run is one
    number, which sorts fast and tells its letters; else runs are numbered by their ends first."""
    points, places, _ = code_points(texts)
    if not len(places):
        return [], np.zeros(0, np.int64)
    letters = np.flatnonzero(np.bincount(points))
    number = np.zeros(int(letters[-1]) + 1, np.int64)
    number[letters] = np.arange(len(letters))
    ids, width = number[points], max(1, int(len(letters) - 1).bit_length())
    if width * ORDER > 63:
        heads = np.unique(ids[places] << 2 * width | ids[places + 1] << width | ids[places + 2], return_inverse=True)
        code = heads[1] << 2 * width | ids[places + 3] << width | ids[places + 4]
        code, index, counts = np.unique(code, return_index=True, return_counts=True)
        rows = points[places[index][:, None] + np.arange(ORDER)]
    else:
        code = ids[places]
        for k in range(1, ORDER):
            code = code << width | ids[places + k]
        code, counts = np.unique(code, return_counts=True)
        shifts = width * np.arange(ORDER - 1, -1, -1)
        rows = letters[code[:, None] >> shifts & ((1 << width) - 1)]
    joined = rows.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [joined[at : at + ORDER] for at in range(0, len(joined), ORDER)], counts


def hashes(points: np.ndarray, places: np.ndarray, lang: str) -> np.ndarray:
    """A 64-bit number for the run of ORDER code points at each place, in this language."""
    n = max(0, len(points) - ORDER + 1)
    wide = points.astype(U)
    total = wide[:n] * RUN[0]
    for k in range(1, ORDER):
        total += wide[k : k + n] * RUN[k]
    seed = mix(np.full(1, (zlib.crc32(lang.encode()) << 32) | len(lang), U))
    return mix(total[places] ^ seed).astype(np.int64)


def numbered(column: pa.Array) -> tuple[list[str], np.ndarray]:
    """The distinct values of a column, and which of them each row has."""
    encoded = column.dictionary_encode()
    return encoded.dictionary.to_pylist(), encoded.indices.to_numpy()


def by_block(batch: pa.RecordBatch) -> Iterator[tuple[int, str, np.ndarray]]:
    """(block, lang, rows of the batch) of what the batch holds of each."""
    if not len(batch):
        return
    block = batch.column("block").to_numpy()
    names, lang = numbered(batch.column("lang"))
    order = np.lexsort((lang, block))
    fresh = np.append(True, (np.diff(block[order]) != 0) | (np.diff(lang[order]) != 0))
    for rows in np.split(order, np.flatnonzero(fresh)[1:]):
        yield int(block[rows[0]]), names[lang[rows[0]]], rows


def count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, lang, rows in by_block(batch):
            texts = map(plain, batch.column("text").take(pa.array(rows)).to_pylist())
            for part in slices(texts, COUNT_CHARS):
                grams, counts = distinct_grams(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(grams), pa.int64()), pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts)],
                    ["block", "lang", "gram", "n"],
                )


# -- the model -----------------------------------------------------------------------------


def in_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, text, block): the block is a hash of the file that a row comes from, so it is the same in
    every job, wherever the row is read. Rows that come from no file, or from joined ones, are stored first."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    block = F.xxhash64(F.col("_metadata.file_path")).alias("block")
    try:
        return rows.select("*", block)
    except AnalysisException:
        return stored(rows, "documents").select("*", block)


def corpus_grams(blocks: DataFrame) -> DataFrame:
    """(block, lang, gram, n), stored."""
    found = blocks.mapInArrow(count_grams, "block BIGINT, lang STRING, gram STRING, n BIGINT")
    return stored(found.groupBy("block", "lang", "gram").agg(F.sum("n").alias("n")), "grams")


@dataclass(frozen=True)
class Level:
    """counts: (lang, gram, c) of runs of k characters, their frequency for k = ORDER, else how many different
    characters stand before them. contexts: (lang, context, total, d1, d2, d3, gamma) of the runs of k - 1 before them."""

    counts: DataFrame
    contexts: DataFrame


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) from the numbers of runs seen one to four times; 0.5, 1 and 1.5 where one of these is 0."""
    seen = counts.groupBy("lang").agg(*(F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in range(1, 5)))
    share = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
    usable = F.least("n1", "n2", "n3", "n4") > 0
    formula = [k - (k + 1) * share * F.try_divide(f"n{k + 1}", f"n{k}") for k in range(1, 4)]
    kept = usable & (F.least(*formula) > 0)
    return seen.select("lang", *(F.when(kept, d).otherwise(k / 2).alias(f"d{k}") for k, d in enumerate(formula, 1)))


def levels_of(grams: DataFrame) -> list[Level]:
    """From runs of one character to runs of ORDER characters; each is stored and a fraction of the next."""
    counts = stored(grams.groupBy("lang", "gram").agg(F.sum("n").alias("c")), "level")
    levels: list[Level] = []
    for k in range(ORDER, 0, -1):
        number = [F.sum((F.col("c") == 1).cast("int")), F.sum((F.col("c") == 2).cast("int")), F.sum((F.col("c") > 2).cast("int"))]
        context = counts.groupBy("lang", F.substring("gram", 1, k - 1).alias("context")).agg(
            F.sum("c").alias("total"), *(x.alias(f"n{j}") for j, x in enumerate(number, 1)), F.count("*").alias("n")
        )
        context = context.join(stored(discounts(counts), "discounts"), "lang")  # one row per language
        gamma = sum((F.col(f"d{j}") * F.col(f"n{j}") for j in range(1, 4)), F.lit(0.0)) / F.col("total")
        contexts = context.select("lang", "context", "total", "n", "d1", "d2", "d3", gamma.alias("gamma"))
        levels.append(Level(counts, stored(contexts, "contexts")))
        if k > 1:
            shorter = counts.groupBy("lang", F.substring("gram", 2, k - 1).alias("gram")).agg(F.count("*").alias("c"))
            counts = stored(shorter, "level")
    return levels[::-1]


def gram_bits(wanted: DataFrame, levels: list[Level]) -> DataFrame:
    """(lang, gram, bits) of the distinct runs (lang, gram): -log2 of the last character's probability after the others.

    A run of one character has its discounted share, the rest is spread evenly over the language's
    characters and one more for all that it lacks; a language without a model has that one only.
    """
    asked = [wanted.select("lang", "gram").distinct()]
    for k in range(ORDER - 1, 0, -1):
        asked.append(stored(asked[-1].select("lang", F.substring("gram", 2, k).alias("gram")).distinct(), "asked"))
    asked.reverse()
    known: DataFrame | None = None
    for k, level in enumerate(levels, 1):
        c = F.col("c")
        discount = F.when(c.isNull(), 0.0).when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        own = (F.coalesce(c, F.lit(0)) - discount) / F.col("total")
        rows = asked[k - 1].join(level.counts, ["lang", "gram"], "left")
        if known is None:
            rows = rows.join(level.contexts.drop("context"), "lang", "left")
            lower = 1 / (F.coalesce("n", F.lit(0)) + 1)
        else:
            shorter = known.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            rows = rows.withColumn("context", F.substring("gram", 1, k - 1)).withColumn("suffix", F.substring("gram", 2, k - 1))
            rows = rows.join(level.contexts, ["lang", "context"], "left").join(shorter, ["lang", "suffix"])
            lower = F.col("lower")
        p = F.when(F.col("total").isNull(), lower).otherwise(own + F.col("gamma") * lower)
        known = stored(rows.select("lang", "gram", p.alias("p")), "known")
    return known.select("lang", "gram", (-F.log2("p")).alias("bits"))


def write_arrays(grams: DataFrame, bits: DataFrame) -> str:
    """A folder with the arrays of each block, in ascending order of hashes."""

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lang = numbered(batch.column("lang"))
            grams = batch.column("gram").to_pylist()
            keys = np.zeros(len(batch), np.int64)
            for k, name in enumerate(names):
                rows = np.flatnonzero(lang == k)
                points, places, _ = code_points([grams[i] for i in rows])
                keys[rows] = hashes(points, places, name)
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(keys), batch.column("bits")], ["block", "key", "bits"])

    folder = scratch_table(grams.sparkSession, "arrays")
    together = grams.select("block", "lang", "gram").join(bits, ["lang", "gram"]).select("block", "lang", "gram", "bits")
    rows = together.mapInArrow(keyed, "block BIGINT, key BIGINT, bits DOUBLE")
    rows.repartition("block").sortWithinPartitions("block", "key").write.partitionBy("block").parquet(folder)
    return folder


class Arrays:
    """The arrays of the block asked for last. Hashes are even, so a key's leading bits tell nearly where it stands:
    `begin` has the first place for each value of these bits, about one for every key."""

    def __init__(self, folder: str) -> None:
        self.files, self.path = pafs.FileSystem.from_uri(folder)
        self.block: int | None = None

    def bits(self, block: int, keys: np.ndarray) -> np.ndarray:
        if block != self.block:
            place = f"{self.path}/block={block}"
            known = self.files.get_file_info(place).type != pafs.FileType.NotFound
            table = pq.read_table(place, filesystem=self.files, columns=["key", "bits"], partitioning=None) if known else None
            self.keys = table.column("key").to_numpy() if known else np.zeros(0, np.int64)
            self.values = table.column("bits").to_numpy() if known else np.zeros(0)
            if np.any(self.keys[1:] < self.keys[:-1]):  # a block in several files
                order = np.argsort(self.keys)
                self.keys, self.values = self.keys[order], self.values[order]
            self.block = block
            self.lead = max(1, len(self.keys).bit_length())
            buckets = np.arange(-(1 << self.lead - 1), 1 << self.lead - 1) << 64 - self.lead
            self.begin = np.searchsorted(self.keys, buckets).astype(np.int32)
        if not len(keys):
            return np.zeros(0)
        if not len(self.keys):
            raise LookupError(MISSING)
        found = self.begin[(keys >> 64 - self.lead) + (1 << self.lead - 1)]
        last = len(self.keys) - 1
        open_keys = np.flatnonzero(self.keys[np.minimum(found, last)] < keys)
        while len(open_keys):
            found[open_keys] += 1
            open_keys = open_keys[self.keys[np.minimum(found[open_keys], last)] < keys[open_keys]]
            open_keys = open_keys[found[open_keys] < last]
        if np.any(self.keys[np.minimum(found, last)] != keys):
            raise LookupError(MISSING)
        return self.values[found]


def score_texts(folder: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrays = Arrays(folder)
    for batch in batches:
        for block, lang, rows in by_block(batch):
            done, taken = 0, batch.take(pa.array(rows))
            for part in slices(taken.column("text").to_pylist(), SCORE_CHARS):
                texts = [text or "" for text in part]
                points, places, counts = code_points([plain(text) for text in texts])
                sums = np.concatenate([[0.0], np.cumsum(arrays.bits(block, hashes(points, places, lang)))])
                ends = np.cumsum(counts)
                columns = [taken.column("doc_id").slice(done, len(texts)), pa.array([lang] * len(texts), pa.string())]
                columns += [pa.array(column, pa.int64()) for column in text_counts(texts)]
                columns += [pa.array(counts), pa.array(sums[ends] - sums[ends - counts])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", *COUNTS, "n_grams", "bits"])
                done += len(texts)


# -- bands and verdict ---------------------------------------------------------------------


def thousandths() -> Column:
    return F.floor(F.col("bits") / F.col("n_grams") * PRECISION)


def bands(scored: DataFrame) -> DataFrame:
    """(lang, lower, upper) in bits a character, from the documents that pass the base rules.

    Quantiles are taken over counts per thousandth of a bit, so a language of any size is a few
    thousand rows, and the same whatever the order of rows.
    """
    bins = scored.where("not base_failed and n_grams > 0").groupBy("lang", thousandths().alias("x")).count()
    ordered = Window.partitionBy("lang").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.sum("count").over(ordered) / F.sum("count").over(Window.partitionBy("lang"))
    at = [F.min(F.when(F.col("share") >= q, F.col("x"))).alias(name) for name, q in (("q16", 0.16), ("q50", 0.5), ("q84", 0.84))]
    found = bins.withColumn("share", share).groupBy("lang").agg(*at)
    least = LEAST_SPREAD * PRECISION
    lower = F.col("q50") - LOWER_WIDTH * F.greatest(F.col("q50") - F.col("q16"), F.lit(least))
    upper = F.col("q50") + 1 + UPPER_WIDTH * F.greatest(F.col("q84") - F.col("q50"), F.lit(least))
    return found.select("lang", (lower / PRECISION).alias("lower"), (upper / PRECISION).alias("upper"))


def score(docs: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """(doc_id, lang, the columns of COUNTS, n_grams, bits): bits is the -log2 of the text's probability, run by run.

    corpus: the documents that the model is made of, by default the same.
    """
    blocks = in_blocks(docs)
    grams = corpus_grams(blocks)
    levels = levels_of(grams if corpus is None else corpus_grams(in_blocks(corpus)))
    folder = write_arrays(grams, gram_bits(grams, levels))
    return blocks.mapInArrow(partial(score_texts, folder), SCORED)


def judge(docs: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id BIGINT, lang STRING, text STRING, more ignored): doc_id, the counts, base_failed,
    bits_per_char, lower, upper, kept.

    Words are runs of anything but ASCII white space. word_chars: characters in words. n_symbols:
    characters of #*$%&|<>. n_dup_lines: lines with a word that equal an earlier one. n_repeat_words:
    words in windows of three words found twice or more. base_failed: under 50 words, or over half
    of the words in such windows. kept: not base_failed, and the text's perplexity (as bits a
    character, its logarithm) within the band of its language.

    A null or empty text has no words and fails. A null lang is the language ''. Rows that repeat
    a doc_id, or have none, are judged each for themselves and counted each in the model. Ties with
    a bound are kept. An empty table gives no rows.
    """
    n = F.col("n_words")
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * n)
    scored = stored(score(docs, corpus).withColumn("base_failed", failed), "scores")
    judged = scored.join(stored(bands(scored), "bands"), "lang", "left")  # one row per language
    per_char = F.when(F.col("n_grams") > 0, F.col("bits") / F.col("n_grams"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("bits_per_char").between(F.col("lower"), F.col("upper")), F.lit(False))
    columns = ["doc_id", *COUNTS, "base_failed", "bits_per_char", "lower", "upper", "kept"]
    return judged.withColumn("bits_per_char", per_char).withColumn("kept", kept).select(*columns)
