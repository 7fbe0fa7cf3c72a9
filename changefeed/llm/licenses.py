"""Licence scan by a positional index of rare words.

Templates are data: the index maps a word to its postings, the templates that are kept under it with the word's
place in their mandatory phrase. A template is kept under the word of its phrase that the fewest documents
hold, counted over all of them, so a document looks up its highest-IDF licence words. Each posting implies a start;
there the phrase's next rarest word must stand in its relative place, then the whole phrase, and only then
words are compared. All of it is built-in column functions over a few constant arrays, so the plan is
the same for any number of templates.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.components import stored


ANCHORS = 2  # rare words of a phrase: the first is what a template is kept under, the other is looked for in its place
MOST_TEMPLATES = 100_000  # so that the index, which goes to every task, stays within some 100 MB
SHARE = 0.75  # of a template's words that must stand in place
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """words: the whole notice; key: its mandatory phrase, a run of those words; base: a phrase of the base search."""

    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool = False

    @property
    def offset(self) -> int:
        return next(k for k in range(len(self.words)) if self.words[k : k + len(self.key)] == self.key)


def template(label: str, text: str, key: str | None = None, base: bool = False) -> Template:
    return Template(label, tuple(text.split()), tuple((key or text).split()), base)


# The phrases of the base search, and notices the method adds, as words.
BASE = (
    template("apache-2", "apache license version 2", base=True),
    template("cc-by-nc", "cc by nc", base=True),
    template("mit", "under the mit license", base=True),
)
NOTICES = (
    template("agpl-3", "gnu affero general public license version 3"),
    template("apache-2", "you may not use this file except in compliance with the license",
             "except in compliance with the license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    template("cc-by-nd", "cc by nd"),
    template("cc-by-sa", "cc by sa"),
    template("cc0", "cc0 1 0 universal"),
    template("epl-2", "eclipse public license version 2"),
    template("gpl-2", "gnu general public license version 2"),
    template("gpl-3", "gnu general public license version 3"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             "distribute this software for any purpose with or without fee"),
    template("lgpl", "gnu lesser general public license"),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    template("mpl-2", "mozilla public license version 2"),
    template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
TEMPLATES = BASE + NOTICES


KIND = "array<struct<label:string,start:bigint,share:double,base:boolean>>"


def read_templates(table: DataFrame) -> tuple[Template, ...]:
    """The base phrases, and further templates from a table (label, text, key): lower-cased words of the notice, and a
    run of them that must stand. Rows whose text does not hold its key, or without one of the three, are refused."""
    rows = table.select(*(F.col(name).cast("string").alias(name) for name in ("label", "text", "key"))).limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates; scan with one part of them after another")
    found = []
    for row in rows:
        words, key = (tuple((part or "").split()) for part in (row["text"], row["key"]))
        if not row["label"] or not key or key not in {words[k : k + len(key)] for k in range(len(words))}:
            raise ValueError(f"no template: {row}")
        found.append(Template(row["label"], words, key))
    return BASE + tuple(found)


def constant(value: object, kind: str) -> str:
    """SQL: a constant of any type, worked out once when the query is planned."""
    text = json.dumps(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"from_json('{text}', '{kind}')"


def lowered(text: Column) -> Column:
    """A to Z lowered. `lower` is faster and as good unless the text holds one of the two other characters whose
    lower-case forms begin with an ASCII letter."""
    return F.when(text.rlike("[\u212a\u0130]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def with_words(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, present, words): present are the licence words of a text; the words themselves are kept
    only where some template's whole phrase may stand, as all its words are there."""
    vocabulary = constant(sorted({word for t in templates for word in t.key}), "array<string>")
    keys = constant(sorted({tuple(sorted(set(t.key))) for t in templates}), "array<array<string>>")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.regexp_extract_all(lowered(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(WORD), F.lit(0)).alias("words"),
    )
    rows = rows.withColumn("present", F.expr(f"array_intersect({vocabulary}, words)"))
    possible = f"exists({keys}, key -> forall(key, word -> array_contains(present, word)))"
    return rows.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), "present", F.when(F.expr(possible), F.col("words")).alias("words")
    )


def rarest_words(present: DataFrame, templates: Sequence[Template] = TEMPLATES) -> dict[Template, list[str]]:
    """The rarest words of each template's phrase: those that the fewest documents hold.

    Document frequencies are counted over all rows; what reaches the driver is one number per
    word of the templates.
    """
    counted = present.select(F.explode("present").alias("word")).groupBy("word").count().collect()
    holders = {row["word"]: row["count"] for row in counted}
    return {t: sorted(set(t.key), key=lambda word: (holders.get(word, 0), word))[:ANCHORS] for t in templates}


def matches(templates: Sequence[Template], anchors: dict[Template, list[str]]) -> str:
    """SQL: (label, start, share, base) of the templates whose phrase stands in `words`, at which start, from 0."""
    postings: dict[str, list[dict]] = {}
    table = []
    for at, t in enumerate(templates):
        first, *others = anchors[t]
        places = [k for k, word in enumerate(t.key) if word == first]
        postings.setdefault(first, []).append({"t": at, "place": places[0]})
        second = others[0] if others else first
        table.append({"label": t.label, "key": t.key, "words": t.words, "lead": t.offset, "base": t.base, "second": second, "apart": t.key.index(second)})
    index = constant(postings, "map<string,array<struct<t:int,place:int>>>")
    kinds = "array<struct<label:string,key:array<string>,words:array<string>,lead:int,base:boolean,second:string,apart:int>>"
    looked_up = (
        "flatten(transform(filter(transform(words, (w, i) -> struct(w as word, i as place)), "
        f"x -> map_contains_key({index}, x.word)), x -> transform(element_at({index}, x.word), "
        f"p -> struct(element_at({constant(table, kinds)}, p.t + 1) as t, x.place - p.place as start))))"
    )
    stands = "c.start >= 0 and get(words, c.start + c.t.apart) <=> c.t.second and slice(words, c.start + 1, size(c.t.key)) = c.t.key"
    in_place = "size(filter(transform(c.t.words, (w, k) -> get(words, c.start + k - c.t.lead) <=> w), same -> same)) / cast(size(c.t.words) as double)"
    found = (
        f"transform(filter({looked_up}, c -> {stands}), c -> struct(c.t.label as label, cast(c.start as bigint) as start, "
        f"if(c.t.base, 1D, {in_place}) as share, c.t.base as base))"
    )
    return f"if(words is null, cast(array() as {KIND}), filter({found}, m -> m.share >= {SHARE}))"


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices), one row per row of
    `docs` (doc_id BIGINT, text STRING, more ignored).

    Words are counted from 0 after lowering A to Z. n_base counts the places of the base phrases,
    first_word and last_word are their smallest and largest start, null if there is none. labels
    adds those of further notices, whose mandatory phrase must stand and three quarters of whose
    words must be in place; notices lists them as (label, start, share). The score is the largest
    share, 1 for a base phrase, 0 without any. Labels are distinct, sorted and joined with commas.

    A null or empty text has no words. Repeated rows and rows without a doc_id are scanned like any
    other. An empty table gives no rows. A text holds its words once, and only while its row is
    worked on; the work grows with its length.
    """
    present = stored(with_words(docs, templates), "licence-words")
    found = present.select("doc_id", "n_words", F.expr(matches(templates, rarest_words(present, templates))).alias("found"))
    found = found.select(
        "doc_id",
        "n_words",
        F.expr("array_sort(transform(filter(found, m -> m.base), m -> struct(m.start as start, m.label as label)))").alias("base"),
        F.expr("array_sort(transform(filter(found, m -> not m.base), m -> struct(m.label as label, m.start as start, m.share as share)))").alias("notices"),
    )
    labels = "array_join(array_sort(array_distinct({})), ',')"
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.expr("array_min(base.start)").alias("first_word"),
        F.expr("array_max(base.start)").alias("last_word"),
        F.expr(labels.format("base.label")).alias("base_labels"),
        F.expr(labels.format("concat(base.label, notices.label)")).alias("labels"),
        F.expr("if(size(base) > 0, 1D, coalesce(array_max(notices.share), 0D))").alias("score"),
        "notices",
    )
