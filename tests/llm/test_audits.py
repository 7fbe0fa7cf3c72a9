"""Filter interactions and periodic runs against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from changefeed.llm import filter_audit, runs
from changefeed.llm.queries import QUERIES, with_planted_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- filters -------------------------------------------------------------------------------


def fails(text, copied):
    words = WORD.findall(text)
    bad = ""
    bad += "A" if len(words) < 200 else ""
    bad += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    bad += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
    bad += "D" if re.search("[#$%&*|]", text) else ""
    return bad + ("E" if copied else "")


def audit_rows(rows, labels):
    """Every order applied filter by filter."""
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    judged = [(doc, lang or "", fails(text or "", doc is not None and first[text or ""] < doc)) for doc, text, lang in rows]
    out, totals = {}, Counter()
    for part in {p for _, p, _ in judged}:
        own = [(doc, bad) for doc, p, bad in judged if p == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                here = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                failing = [x for x in own if letter in x[1]]
                lost = [labels.get(doc, (0, 0)) for doc, _ in here]
                totals[part, letter] += len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), len(failing) - len(here), sum(bad == letter for _, bad in own),
                    sum(q for q, _ in lost), sum(t for _, t in lost),
                ]
    return {key: (*values, totals[key[0], key[1][key[2] - 1]]) for key, values in out.items()}


def audit_corpus():
    rng = random.Random(4)
    texts = []
    for _ in range(120):
        n = rng.choice((3, 150, 199, 200, 260))
        pool = [f"w{k}" for k in range(rng.choice((n // 2, 2 * n)) + 1)]
        words = [rng.choice(pool) for _ in range(n)]
        if rng.random() < 0.3:
            words[0] = "AB" * rng.randint(1, 40)
        if rng.random() < 0.2:
            words[-1] += rng.choice("#$%&*|")
        texts.append(rng.choice((" ", "\n", " \t ")).join(words))
    texts += [None, "", " \n", "é" * 30, "x y\u001cz", "W" * 100_000, *texts[:40], *texts[:5], None]
    rows = [(k, text, rng.choice(("en", "fr", "", None))) for k, text in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [rows[0], rows[1], (None, texts[0], "en"), (None, None, None)]


def test_audit_follows_every_order(spark):
    rows = audit_corpus()
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 150, 2)]
    marks = {doc: (q, int(t)) for doc, q, t in labels}
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id bigint, text string, lang string, failed int, digest string")
    table = spark.createDataFrame([(d, q, int(t)) for d, q, t in labels] + [(None, 1, 1), (0, 0, None)], "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(docs.repartition(5), table).collect()
    found = {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in got
    }
    assert len(got) == len(found) == 3 * 600
    assert found == audit_rows(rows, marks)
    assert filter_audit.audit(docs.where("false"), table).collect() == []
    assert filter_audit.audit(docs, table.where("false")).count() == 3 * 600


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_least_squares_gives_shapley_shares(n):
    rng = random.Random(n)
    value = [0] + [rng.randint(-50, 50) for _ in range((1 << n) - 1)]
    for i, row in enumerate(filter_audit.shapley_weights(n)):
        orders = list(itertools.permutations(range(n)))
        total = 0
        for order in orders:
            before = sum(1 << k for k in order[: order.index(i)])
            total += value[before | 1 << i] - value[before]
        assert sum(w * v for w, v in zip(row, value, strict=True)) == Fraction(total, len(orders))


# -- runs ----------------------------------------------------------------------------------


def all_runs(words):
    """Runs by looking at every period: (start, length, period), smallest periods only."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            if end > at and length >= max(24, 3 * q):
                found.setdefault((at, length), q)
            at = max(end, at) + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def symbols(words):
    return np.unique(np.array(words), return_inverse=True)[1].astype(np.int64)


def run_texts():
    rng = random.Random(6)
    texts = [["a"] * n for n in (1, 23, 24, 25, 100, 257)]
    for _ in range(250):
        words = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(1, 4)):
            base = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.randint(1, 40))]
            if rng.random() < 0.5:  # periods inside a period
                base = base * rng.randint(1, 6) + base[:1] + [rng.choice("abx")]
            words += base * rng.randint(2, 6) + base[: rng.randint(0, len(base))]
            words += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 20))]
        texts.append(words)
    for p in range(1, 41):  # a long stretch of one word inside a longer period
        texts.append((["a"] * p + ["b"]) * 7)
        texts.append((["a", "b"] * p + ["c"] + ["a"] * (p // 2)) * 4)
    return texts


def test_runs_are_all_found():
    for words in run_texts():
        start, length, period = runs.find_runs(symbols(words))
        assert list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True)) == all_runs(words), words
    assert len(runs.find_runs(np.zeros(0, np.int64))[0]) == 0


def test_every_short_binary_text():
    rng = random.Random(2)
    for _ in range(3000):
        words = [rng.choice("ab") for _ in range(rng.randint(1, 7))] * 12
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice("abc")
        start, length, period = runs.find_runs(symbols(words))
        assert list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True)) == all_runs(words), words


def test_wavelet_tree():
    rng = np.random.default_rng(3)
    values = rng.permutation(300)
    tree = runs.WaveletTree(values)
    left = rng.integers(0, 299, 500)
    right = np.minimum(left + rng.integers(1, 80, 500), 300)
    bound = rng.integers(0, 700, 500)
    below = tree.below(left, right, bound)
    assert below.tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(left, right, bound, strict=True)]
    nth = np.minimum(below, right - left - 1)
    assert tree.smallest(left, right, nth).tolist() == [sorted(values[a:b])[k] for a, b, k in zip(left, right, nth, strict=True)]


def planted(doc, words):
    h = zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def run_row(doc, text):
    words = planted(doc, WORD.findall(text or ""))
    found = all_runs(words)
    dropped = {i for start, length, q in found for i in range(start + q, start + length)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    return (
        doc, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def test_op13_equals_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = [(k, rng.choice((" ", "\n ", "\t")).join(words)) for k, words in enumerate(run_texts())]
    rows += [(1000 + k, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randint(0, 90)))) for k in range(300)]
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "a a " * 30), (None, "b " * 40), rows[7], rows[7]]
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id bigint, text string, runs int, _n string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op13_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((run_row(*row) for row in rows), key=str)
    assert sum(zlib.crc32(str(doc).encode()) % 10 == 0 for doc, _ in rows) > 30
    assert with_planted_runs(docs).columns == docs.columns
    assert runs.collapse_runs(docs.where("doc_id < 0")).collect() == []


def test_long_text_with_long_periods(spark):
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(9000)]
    words = base[:500] + base * 3 + ["end"]
    text = " ".join(words)
    (row,) = runs.collapse_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert [tuple(r) for r in row.runs] == [(500, 27000, 9000)] and tuple(row.longest) == (500, 27000, 9000)
    assert row.text.split() == base[:500] + base + ["end"]
