"""Toxicity by a weighted finite-state pattern grammar over clauses.

A clause is read as a string of symbols: target, negation, reported speech, a colon, other words.
Four small transducers, each a table of states, read it: one marks what a negation governs, one what is
reported, one what has a target close before it, and one, from right to left, close behind it. The three that read
forward are composed into one table over the reachable triples of their states. The insult and threat transducer
is a trie of word beginnings whose accepting states carry weights learned from labels; its output is
written under the marks of the others: an insult as reported, negated, aimed or plain, a threat as
reported, negated or, with a target on either side, as a threat. A document's features are the
weights so marked; a logistic model over them, fitted on the same labelled rows, gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.workers import tidy

TOXIC_ROWS, CLEAN_ROWS = 4_000, 8_000  # labelled rows the model is fitted on, at most
CANDIDATES, INSULTS = 5_000, 512
PREFIX = range(3, 11)
LEAST_DOCUMENTS, PRECISION, LEAST_GAIN = 4, 0.98, 3
THRESHOLD = 0.7
REACH = 4  # words between a marker and what it governs

# Word classes of the grammar, in the languages of the corpus. A final "*" takes any ending.
INSULT_WORDS = "idiot idiots moron morons stupid scum trash loser losers worthless pathetic disgusting clown clowns".split()
THREAT_WORDS = "kill hurt destroy beat töten schlagen umbringen tuer frapper détruire matar golpear destruir".split()
TARGET_WORDS = (
    "you your yours he she they them his her their him du dich dir ihr euch sie er "
    "tu toi vous te ils elles lui tú usted ustedes vosotros ellos ellas"
).split()
NEGATION_WORDS = "not no never without isn't aren't nicht kein keine nie ohne ne pas jamais sans nunca ningún sin".split()
REPORT_WORDS = (
    "said says say wrote called claims reported quoted quote sagte sagt schrieb zitiert "
    "dit écrit cité dijo dice escribió citado"
).split()

WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
CLAUSE_END = re.compile(r"[.!?;\n]")
TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?|:")
OTHER, TARGET, NEGATION, REPORT, COLON = SYMBOLS = range(5)
FEATURES = ("plain", "aimed", "negated", "reported", "threat")
PRIOR = np.array([-4.0, 6.0, 7.0, 3.0, 3.0, 4.0])  # bias first; what no labelled row speaks about stays here


@dataclass(frozen=True)
class Model:
    insults: tuple[tuple[str, float], ...]
    weights: tuple[float, ...]


@dataclass(frozen=True)
class Transducer:
    """States from 0, the start; table[state][symbol] is the next one; marks[state] is what is written under a
    word that is read in this state."""

    table: tuple[tuple[int, ...], ...]
    marks: tuple[tuple[bool, ...], ...]

    def __matmul__(self, other: Transducer) -> Transducer:
        """Both at once: over the pairs of states that can be reached, marks side by side."""
        pairs, table = [(0, 0)], []
        for a, b in pairs:
            row = []
            for symbol in SYMBOLS:
                pair = self.table[a][symbol], other.table[b][symbol]
                if pair not in pairs:
                    pairs.append(pair)
                row.append(pairs.index(pair))
            table.append(tuple(row))
        return Transducer(tuple(table), tuple((*self.marks[a], *other.marks[b]) for a, b in pairs))


def reaching(trigger: int) -> Transducer:
    """Marks the REACH words behind a trigger; a colon ends that."""
    table = tuple(
        tuple(REACH if s == trigger else 0 if s == COLON else max(left - 1, 0) for s in SYMBOLS) for left in range(REACH + 1)
    )
    return Transducer(table, tuple((left > 0,) for left in range(REACH + 1)))


def latched(trigger: int) -> Transducer:
    """Marks everything behind a trigger, behind a colon too."""
    return Transducer(tuple(tuple(int(on or s == trigger) for s in SYMBOLS) for on in (0, 1)), ((False,), (True,)))


FORWARD = reaching(NEGATION) @ latched(REPORT) @ reaching(TARGET)
BACKWARD = reaching(TARGET)


class Grammar:
    """The transducers of one model, ready to read texts."""

    def __init__(self, insults: Iterable[tuple[str, float]]) -> None:
        self.insults = dict(insults)
        self.symbols = {word: TARGET for word in TARGET_WORDS} | {":": COLON}
        self.symbols |= {word: NEGATION for word in NEGATION_WORDS} | {word: REPORT for word in REPORT_WORDS}
        self.threats = set(THREAT_WORDS)
        self.starts = ahocorasick.Automaton()
        for start in {*(key.rstrip("$") for key in self.insults), *self.threats}:
            self.starts.add_word(start, start)
        if len(self.starts):
            self.starts.make_automaton()

    def insult(self, word: str) -> float:
        """The weight of the first accepting state on the word's path through the trie."""
        for end in PREFIX:
            if end >= len(word):
                break
            if word[:end] in self.insults:
                return self.insults[word[:end]]
        return self.insults.get(word, 0.0) or self.insults.get(f"{word}$", 0.0)

    def clauses(self, text: str) -> Iterator[str]:
        """Clauses in which some insult or threat may begin, whole."""
        if not len(self.starts):
            return
        done = 0
        for end, start in self.starts.iter(text):
            begin = end - len(start) + 1
            if begin < done or (begin and (text[begin - 1].isalnum())):
                continue
            first = done
            for mark in CLAUSE_END.finditer(text, done, begin):
                first = mark.end()
            after = CLAUSE_END.search(text, end + 1)
            done = after.start() if after else len(text)
            yield text[first:done]

    def read(self, clause: str) -> dict[str, float]:
        """Weights of what a clause says, by the marks of the transducers."""
        words = TOKEN.findall(clause)
        symbols = [self.symbols.get(word, OTHER) for word in words]
        followed, state = [False] * len(words), 0
        for at in reversed(range(len(words))):
            followed[at] = BACKWARD.marks[state][0]
            state = BACKWARD.table[state][symbols[at]]
        out, state = dict.fromkeys(FEATURES, 0.0), 0
        for word, symbol, before_target in zip(words, symbols, followed, strict=True):
            weight, threat = self.insult(word), word in self.threats
            if weight or threat:
                negated, reported, behind_target = FORWARD.marks[state]
                aimed = behind_target or before_target
                if weight:
                    out["reported" if reported else "negated" if negated else "aimed" if aimed else "plain"] += weight
                elif aimed:
                    out["reported" if reported else "negated" if negated else "threat"] += 1.0
            state = FORWARD.table[state][symbol]
        return out

    def features(self, text: str | None) -> list[float]:
        totals = dict.fromkeys(FEATURES, 0.0)
        for clause in self.clauses((text or "").lower()):
            for mark, weight in self.read(clause).items():
                totals[mark] += weight
        return [math.log1p(totals[mark]) for mark in FEATURES]


def prefixes(text: str | None) -> set[str]:
    """Beginnings of the words of a text; a whole word ends in "$"."""
    out = set()
    for word in {match.group() for match in WORD.finditer((text or "").lower())}:
        marked = f"{word}$"
        out.update(marked[:n] for n in PREFIX if n <= len(marked))
    return out


def held_in(part: Column, of: int, out: int) -> Column:
    return F.pmod(F.crc32(part.cast("string").cast("binary")), F.lit(of)) != out


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, text) of at most TOXIC_ROWS and CLEAN_ROWS documents, chosen by a hash of the id, equal texts once."""
    marked = labels.where("toxic is not null and doc_id is not null").where(held_in(F.col("doc_id"), 3, 1))
    marked = marked.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marked.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS)
    chosen = chosen.unionByName(marked.where("toxic = 0").orderBy(*order).limit(CLEAN_ROWS))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))


def count_prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, toxic documents, clean documents) of one task."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, mark in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            (toxic if mark else clean).update(prefixes(text))
    kept = list(toxic)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(kept, pa.string()),
            pa.array([toxic[p] for p in kept], pa.int64()),
            pa.array([clean[p] for p in kept], pa.int64()),
        ],
        ["prefix", "toxic", "clean"],
    )
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([p for p in clean if p not in toxic], pa.string()),
            pa.array([0] * sum(p not in toxic for p in clean), pa.int64()),
            pa.array([clean[p] for p in clean if p not in toxic], pa.int64()),
        ],
        ["prefix", "toxic", "clean"],
    )


def choose_insults(counts: dict[str, tuple[int, int]], holders: list[set[str]]) -> list[tuple[str, float]]:
    """Word beginnings that, taken greedily, each mark further toxic documents and hardly any clean one.

    A beginning is taken at its longest form that loses none of its documents, so chance words of
    the copies of one document, which explain nothing new, never enter.
    """
    open_docs = list(holders)
    chosen: list[tuple[str, float]] = []
    while open_docs and len(chosen) < INSULTS:
        gain = Counter(p for held in open_docs for p in held if p in counts)
        if not gain:
            break
        most = max(gain.values())
        if most < LEAST_GAIN:
            break
        best = max((p for p, n in gain.items() if n == most), key=lambda p: (counts[p][0], len(p), p))
        toxic, clean = counts[best]
        chosen.append((best, round(math.log1p(toxic / (clean + 1)) / 4, 6)))
        open_docs = [held for held in open_docs if best not in held]
    return chosen


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn insults and weights from labels of rows whose crc32(doc_id) mod 3 is not 1.

    At most TOXIC_ROWS + CLEAN_ROWS labelled documents are read for it, whatever the size of the
    tables. Without labels the fixed words and prior weights stand. Only texts are inputs.
    """
    sample = labelled_sample(docs, labels)
    counted = sample.mapInArrow(tidy(count_prefixes), "prefix STRING, toxic BIGINT, clean BIGINT")
    counted = counted.groupBy("prefix").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    good = counted.where(F.col("toxic") >= LEAST_DOCUMENTS).where(F.expr(f"toxic >= {PRECISION} * (toxic + clean)"))
    best = good.orderBy(F.desc("toxic"), "prefix").limit(CANDIDATES).collect()
    counts = {row.prefix: (row.toxic, row.clean) for row in best}

    def hold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(prefixes(text) & counts.keys()) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.string()))], ["held"])

    toxic_only = sample.where("toxic = 1").select("text")
    holders = [set(row.held) for row in toxic_only.mapInArrow(tidy(hold), "held ARRAY<STRING>").collect()] if counts else []
    learned = dict(choose_insults(counts, holders))
    insults = tuple(sorted(({f"{word}$": 1.0 for word in INSULT_WORDS} | learned).items()))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(insults)
        for batch in batches:
            rows = [grammar.features(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(tidy(measure), "x ARRAY<DOUBLE>, toxic INT").collect()
    x = np.array([row.x for row in rows]).reshape(len(rows), len(FEATURES))
    return Model(insults, logistic(x, np.array([row.toxic for row in rows], float)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton steps, held to the prior by a ridge."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = PRIOR.copy()
    for _ in range(steps if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 4.0 / np.abs(step).max(initial=1e-9))
    return tuple(float(v) for v in w)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted), one row per row of `docs` (doc_id BIGINT, text STRING, more ignored).

    The score lies between 0 and 1; predicted is 1 from `threshold` on. Whole texts are read. A null
    or empty text has the score of one without matched clauses. Repeated rows and rows without
    a doc_id are scored like any other. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.insults)
        for batch in batches:
            scores = pa.array(text_scores(grammar, model, batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    scored = rows.mapInArrow(tidy(run), "doc_id BIGINT, score DOUBLE")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def text_scores(grammar: Grammar, model: Model, texts: list[str | None]) -> np.ndarray:
    x = np.array([grammar.features(text) for text in texts]).reshape(len(texts), len(FEATURES))
    return 1 / (1 + np.exp(-np.clip(model.weights[0] + x @ np.array(model.weights[1:]), -30, 30)))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, with all their columns; each is judged where it is read.

    Null and empty texts have the score of a text without matched clauses. Repeated rows are judged alike,
    rows without a doc_id like any other. An empty table stays empty.
    """

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.insults)
        for batch in batches:
            clean = text_scores(grammar, model, batch.column("text").to_pylist()) < threshold
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(tidy(keep), docs.schema)
