"""Quality rules and perplexity against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from changefeed.llm import perplexity
from changefeed.llm.queries import QUERIES

DOC = "doc_id bigint, lang string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n")]
    dup = sum(bool(WORD.search(line)) and line in lines[:k] for k, line in enumerate(lines))
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def plain(text):
    return re.sub("[1-9]", "0", " ".join(WORD.findall(text or ""))).lower()


class Model:
    """Interpolated modified Kneser-Ney over runs of five characters, by dictionaries."""

    def __init__(self, texts, order=5):
        self.order = order
        self.c = {order: Counter(t[i : i + order] for t in texts for i in range(len(t) - order + 1))}
        for k in range(order - 1, 0, -1):
            self.c[k] = Counter(gram[1:] for gram in self.c[k + 1])
        self.d, self.after = {}, {}
        for k, table in self.c.items():
            n = [sum(v == j for v in table.values()) for j in range(1, 5)]
            self.d[k] = [0.5, 1.0, 1.5]
            if min(n) > 0:
                y = n[0] / (n[0] + 2 * n[1])
                found = [j - (j + 1) * y * n[j] / n[j - 1] for j in range(1, 4)]
                if min(found) > 0:
                    self.d[k] = found
            self.after[k] = defaultdict(list)
            for gram, v in table.items():
                self.after[k][gram[:-1]].append(v)

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.c[1]) + 1)
        lower, seen = self.p(gram[1:]), self.after[k].get(gram[:-1])
        if not seen:
            return lower
        d = [0, *self.d[k]]
        gamma = sum(d[min(v, 3)] for v in seen) / sum(seen)
        v = self.c[k][gram]
        return (v - d[min(v, 3)]) / sum(seen) + gamma * lower

    def bits(self, text):
        return -sum(math.log2(self.p(text[i : i + self.order])) for i in range(len(text) - self.order + 1))


def corpus():
    rng = random.Random(5)
    rows = []
    for k in range(140):
        lang = rng.choice(("en", "fr", None))
        letters = {"en": "etaoin shrd", "fr": "éaisn trul"}.get(lang, "xyz ")
        lines = []
        for _ in range(rng.randint(1, 6)):
            lines.append("".join(rng.choice(letters) for _ in range(rng.randint(5, 300))))
            if rng.random() < 0.3:
                lines.append(rng.choice(lines))
        rows.append((k, lang, "\n".join(lines)))
    rows += [
        (200, "en", None), (201, "en", ""), (202, "fr", " \n\t "), (203, "de", "abcd"), (204, "de", "Ab1 2cd <>#"),
        (205, None, "same words here " * 30), (206, "en", "QX#%7" * 400), (None, "en", rows[3][2]), rows[4], rows[4],
        (207, "zh", "".join(chr(0x4E00 + rng.randrange(9000)) for _ in range(6000))),
        (208, "en", "a b c\na b c\n\n\n  \n  \na b c d\u001ce"),
    ]
    return rows


def judged(rows):
    texts = defaultdict(list)
    for _, lang, text in rows:
        texts[lang or ""].append(plain(text))
    models = {lang: Model(t) for lang, t in texts.items()}
    out, good = [], defaultdict(list)
    for doc, lang, text in rows:
        c, own = counts(text), plain(text)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        x = models[lang or ""].bits(own) / (len(own) - 4) if len(own) > 4 else None
        if not failed and x is not None:
            good[lang or ""].append(math.floor(x * 1000))
        out.append((doc, lang or "", c, failed, x))
    limits = {}
    for lang, xs in good.items():
        xs.sort()
        q = [next(x for k, x in enumerate(xs, 1) if k / len(xs) >= share) for share in (0.16, 0.5, 0.84)]
        limits[lang] = (q[1] - 4 * max(q[1] - q[0], 50)) / 1000, (q[1] + 1 + 4 * max(q[2] - q[1], 50)) / 1000
    rows = []
    for doc, lang, c, failed, x in out:
        low, high = limits.get(lang, (None, None))
        kept = not failed and x is not None and low is not None and low <= x <= high
        rows.append((doc, c, failed, None if x is None else round(x, 6), kept))
    return rows


def read_back(judgement):
    return [
        (r.doc_id, tuple(r[c] for c in perplexity.COUNTS), r.base_failed, None if r.bits_per_char is None else round(r.bits_per_char, 6), r.kept)
        for r in judgement.collect()
    ]


def test_judgement_equals_brute_force(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame([(*row, 7, "x") for row in rows], DOC + ", block int, bits string")
    expected = sorted(judged(rows), key=str)
    assert sorted(read_back(perplexity.judge(docs.repartition(3))), key=str) == expected
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    query = QUERIES["op12_perplexity"](spark, str(tmp_path))
    assert sorted(read_back(query), key=str) == expected
    assert {r[4] for r in expected} == {True, False}
    assert perplexity.judge(docs.where("doc_id < 0")).collect() == []


def test_other_texts_back_off(spark):
    """Documents that the model has not seen, languages without a model included."""
    rows = corpus()
    rng = random.Random(7)
    other = [(k, lang, "".join(rng.choice("etaoin é#%日 xq") for _ in range(300))) for k, lang in enumerate(("en", "fr", None, "nn"))]
    scored = perplexity.score(spark.createDataFrame(other, DOC), spark.createDataFrame(rows, DOC)).collect()
    texts = defaultdict(list)
    for _, lang, text in rows:
        texts[lang or ""].append(plain(text))
    for r in scored:
        expected = Model(texts[r.lang]).bits(plain(other[r.doc_id][2]))
        assert r.bits == pytest.approx(expected, rel=1e-9)


def test_probabilities_add_up():
    model = Model([plain(text) for _, lang, text in corpus() if lang == "en"])
    letters = list(model.c[1])
    for context in ("etao", "qzzz", "s in"):
        total = sum(model.p(context + letter) for letter in letters)
        assert total == pytest.approx(1, abs=0.2 / len(letters))


def test_distinct_runs_of_any_alphabet():
    rng = random.Random(1)
    for letters in ("ab", "abcdefgh é", [chr(0x3000 + k) for k in range(9000)], [chr(p) for p in range(0x10000, 0x10100)]):
        texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (0, 1, 4, 5, 6, 500, 3000)]
        grams, n = perplexity.distinct_grams(texts)
        assert dict(zip(grams, n.tolist(), strict=True)) == Counter(t[i : i + 5] for t in texts for i in range(len(t) - 4))


def test_counts_of_long_text():
    text = "word " * 200_000 + "x" * 1_000_000
    assert perplexity.text_counts([text])[0] == [200_001]
    assert perplexity.text_counts([text])[4] == [200_000]
    assert perplexity.text_counts([]) == [[]] * 5
    assert len(np.unique(perplexity.hashes(*perplexity.code_points(["abcdefgh"])[:2], "en"))) == 4
