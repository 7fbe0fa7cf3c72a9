"""Sketches, components, near-duplicate documents and lines, against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changefeed.llm import lines, minhash, sketch
from changefeed.llm.components import connected_components
from changefeed.llm.near import BLOCK_BINS, Likeness, agreeing, block_pairs, first_met, near_components, packed, parities
from changefeed.llm.sketch import EMPTY, sketches
from changefeed.llm.words import SEGMENT_BYTES, SPACES, U, character_runs, mix, runs, text_words
from tests.llm import brute

DOC = "doc_id bigint, text string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(n))


def edited(rng, text, share):
    return " ".join(prose(rng, 1) if rng.random() < share else word for word in text.split())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = []
    for _ in range(12):
        base = prose(rng, rng.randint(3, 120))
        rows.append(base)
        rows += [edited(rng, base, rng.choice((0, 0.01, 0.03, 0.08))) for _ in range(rng.randint(0, 6))]
    rows += ["", "  \n ", "One", "one", "a b c d", "A B C D", "a b c d e"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_words_do_not_depend_on_segments():
    long = "x" * (SEGMENT_BYTES + 5) + " tail " + "ab " * 1000
    alone = [h for _, h in text_words([b"ab", long.encode(), b"", b"tail"], SPACES)]
    assert [len(h) for h in alone] == [1, 1002, 0, 1]
    assert alone[0][0] == alone[1][2] and alone[3][0] == alone[1][1]
    assert len(np.unique(alone[1])) == 3


def test_character_runs_of_long_and_short_texts():
    text = "".join(random.Random(1).choices("abé日", k=SEGMENT_BYTES + 100))
    flat, sizes = character_runs(["", "ab", text, "abcdefghi"], 8)
    assert sizes.tolist() == [0, 1, len(text) - 7, 2]
    assert len(np.unique(flat[1:-2])) == len({text[i : i + 8] for i in range(len(text) - 7)})


def test_sketches_agree_as_often_as_sets():
    rng = np.random.default_rng(5)
    for size, share in ((3, 0.5), (40, 0.75), (3000, 0.3)):
        common = int(size * 2 * share / (1 + share))
        agree = []
        for _ in range(40):
            items = mix(rng.integers(1 << 62, size=2 * size - common, dtype=np.uint64))
            both = np.concatenate([items[:size], items[size - common :]])
            table = sketches(both, np.array([size, size]), 128)
            assert (table != EMPTY).all()
            agree.append((table[0] == table[1]).mean())
        assert abs(np.mean(agree) - common / (2 * size - common)) < 0.03
        assert np.std(agree) < 0.06


def test_empty_set_has_no_sketch():
    assert (sketches(np.zeros(0, U), np.array([0]), 8) == EMPTY).all()


def test_runs_of_short_texts_are_whole():
    words = np.arange(1, 5, dtype=U)
    assert len(runs(words, 5)) == 1 and len(runs(words[:0], 5)) == 0 and len(runs(np.arange(9, dtype=U), 5)) == 5


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 380)]
    edges += [(500, 500 + k) for k in range(60)]
    sets = {}
    for a, b in edges:
        joined = sets.get(a, {a}) | sets.get(b, {b})
        for x in joined:
            sets[x] = joined
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {x: min(s) for x, s in sets.items() if len(s) > 1}
    assert connected_components(df.where("a < 0")).collect() == []


def test_minhash_is_exact(spark, corpus):
    sets = {i: brute.word_shingles(text) for i, text in corpus}
    expected = brute.components({i: s for i, s in sets.items() if s}, 75)
    got = minhash.near_duplicates(spark.createDataFrame(corpus, DOC).repartition(5)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: expected.get(i, i) for i in sets}
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_finds_links_beside_the_hub(spark):
    """In a crowd whose members mostly miss the hub, chains of links must still be found."""
    rng = random.Random(8)
    text, rows = prose(rng, 200), []
    for k in range(70):
        words = text.split()
        for at in rng.sample(range(200), 2):
            words[at] = prose(rng, 1)
        text = " ".join(words)
        rows.append((k, text))
    sets = {i: brute.word_shingles(t) for i, t in rows}
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert got == brute.components(sets, 75)


def test_minhash_edges(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "a b c d e f", None), (None, "a b c d e f", "y"), (3, None, "z"), (4, "", "z")]
    docs = spark.createDataFrame(rows, DOC + ", component string").withColumnRenamed("component", "key")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True), (3, 3, True), (4, 4, True)], key=str)
    mapped = docs.withColumn("labels", F.create_map(F.lit("a"), "text"))
    assert minhash.drop_near_duplicates(mapped).count() == 4
    assert minhash.drop_near_duplicates(docs.where("doc_id > 2")).count() == 2
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None"]
    assert minhash.near_duplicates(docs.where("doc_id > 9")).collect() == []


def test_lines_are_exact(spark, corpus):
    rng = random.Random(4)
    pool = [edited(rng, prose(rng, rng.randint(1, 30)), 0.1) for _ in range(20)]
    rows = []
    for i in range(40):
        parts = [rng.choice(pool) for _ in range(rng.randint(0, 6))]
        parts = [edited(rng, part, 0.02) if rng.random() < 0.5 else f"  {part}\t" for part in parts]
        rows.append((i, "\n".join([*parts, "", "short", "repeated line of every text"])))
    rows += [(100, None), (101, ""), (102, "x" * 50_000 + "\n" + "y" * 9), (None, pool[0])]
    got = lines.line_classes(spark.createDataFrame(rows, DOC).repartition(4)).collect()
    found = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no) for r in got}
    assert found == brute.line_classes(rows)
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.kept_doc_id, r.kept_line_no)) for r in got)


def test_lines_at_the_threshold_share_a_band():
    """Pairs with a similarity of just 0.8: 80 runs shared, ten more on each side."""
    rng = random.Random(21)
    letters = [("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in (87, 10, 10)) for _ in range(3000)]
    pairs = [(common + a, common + b) for common, a, b in letters]
    sides = [lines.LIKENESS.keys(list(side)) for side in zip(*pairs, strict=True)]
    assert all(lines.LIKENESS.alike(*lines.LIKENESS.sets(list(pair))) for pair in pairs[:50])
    assert np.count_nonzero((sides[0] != sides[1]).all(axis=1)) <= 1


def test_drop_lines(spark):
    rows = [
        (1, "first of the lines\nonly in document one\nend", 5, "q"),
        (2, "first of the lines\nonly in document two, this", 5, "q"),
        (3, "first of the lines", 5, "q"),
        (4, "short", 5, "q"),
        (6, "ok\nonly in six, which repeats a line\n\nok", 5, "q"),
        (7, "  ok ", 5, "q"),
        (5, None, None, "q"),
        (None, "first of the lines", 5, "q"),
    ]
    docs = spark.createDataFrame(rows, DOC + ", n_chars bigint, gone_lines string").withColumn("_gone", F.create_map("doc_id", "text"))
    docs = docs.where("doc_id is not null").unionByName(docs.where("doc_id is null").withColumn("_gone", F.lit(None)))
    left = lines.drop_lines(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in left.collect()), key=str) == sorted(
        [
            (1, "first of the lines\nonly in document one\nend", 43),
            (2, "only in document two, this", 26),
            (4, "short", 5),
            (6, "ok\nonly in six, which repeats a line\n", 37),
            (5, None, None),
            (None, "first of the lines", 18),
        ],
        key=str,
    )
    assert lines.drop_lines(docs.where("doc_id > 9")).collect() == []
    assert lines.line_classes(docs.where("doc_id > 9")).collect() == []


def test_blocks_hold_large_buckets(spark, monkeypatch):
    """Members outside the hub's component are compared block by block."""
    monkeypatch.setattr("changefeed.llm.near.BLOCK", 8)
    rng = random.Random(9)
    hub, other = prose(rng, 40), prose(rng, 40)
    rows = [(0, hub)] + [(k, edited(rng, other, 0.01)) for k in range(1, 40)]
    texts = spark.createDataFrame(rows, "id bigint, text string")
    keys = texts.selectExpr("id", "cast(1 as bigint) as key")
    likeness = Likeness(minhash.document_sets, 128, 4, 75)
    got = near_components(keys, lambda ids: texts.join(ids, "id", "left_semi"), likeness)
    expected = brute.components({i: brute.word_shingles(t) for i, t in rows}, 75)
    found = {r.node: r.component for r in got.collect()}
    assert {i: found.get(i, i) for i in expected} == expected


def test_short_lines_and_changed_characters(spark):
    """Exact copies of any length are found; of a usual line, one changed character too."""
    base = "the quick brown fox jumps over one lazy dog and more"
    rows = [(1, f"a\nab\n{base}"), (2, f"ab\nb\n{base[:-1]}!"), (3, "a\n  a\n\nab"), (4, "abcd\nabcde")]
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no) for r in lines.line_classes(spark.createDataFrame(rows, DOC)).collect()}
    assert got == brute.line_classes(rows)
    assert got[2, 2] == (1, 2) and got[3, 0] == got[3, 1] == (1, 0) and got[3, 3] == (1, 1) and got[4, 0] == (4, 0)


def test_hot_keys_are_spread(spark, monkeypatch):
    monkeypatch.setattr("changefeed.llm.components.LEAST_HOT", 5)
    rows = [(k, "the same line everywhere\n" + f"line number {k} " * 9) for k in range(40)]
    docs = spark.createDataFrame(rows, DOC)
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no) for r in lines.line_classes(docs).collect()}
    assert got == brute.line_classes(rows)
    copies = spark.createDataFrame([(k, "one two three four five six" if k % 3 else f"w{k} " * 9) for k in range(40)], DOC)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(copies).collect()} == {k: 1 if k % 3 else k for k in range(40)}


def test_line_keys_go_in_lists():
    """Rows between tasks grow with the parts that keys are dealt to, not with lines times bands."""
    rng = random.Random(31)
    bodies = [prose(rng, 20) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(bodies)], ["id", "body"])
    rows = [row for out in lines.line_keys([batch, batch], 7) for row in out.to_pylist()]
    assert len(rows) <= 7
    got = [(row["part"], key, k) for row in rows for key, k in zip(row["keys"], row["ids"], strict=True)]
    expected = [(key, k) for k, keys in enumerate(lines.LIKENESS.keys(bodies).tolist()) for key in keys]
    assert sorted((key, k) for _, key, k in got) == sorted(expected)
    assert len({(part, key) for part, key, _ in got}) == len({key for key, _ in expected})


@pytest.mark.parametrize("held", [2, 1 << 20])
def test_buckets_met_in_several_chunks(monkeypatch, held):
    """All ids of a key have its first hub in common, however the key's rows come in; ids that come again add nothing."""
    monkeypatch.setattr("changefeed.llm.near.PART_KEYS", held)
    rng = np.random.default_rng(32)
    keys, ids = rng.integers(-30, 30, 200), rng.integers(0, 25, 200)
    keys, ids = np.append(keys, [99, 99, 99]), np.append(ids, [7, 7, 7])
    batches = [packed(ids[at : at + 3], keys[at : at + 3], 1) for at in range(0, len(ids), 3)]
    found = [(row["id"], row["hub"]) for out in first_met([batches[0].slice(0, 0), *batches]) for row in out.to_pylist()]
    buckets = {key: set(ids[keys == key].tolist()) for key in keys.tolist()}
    for bucket in buckets.values():
        assert len(bucket) == 1 or any(all((k, hub) in found for k in bucket) for hub in bucket)
    assert all(any({k, hub} <= bucket and len(bucket) > 1 for bucket in buckets.values()) for k, hub in found)
    if held > 2:
        assert sorted(found) == sorted({(k, min(bucket)) for bucket in buckets.values() if len(bucket) > 1 for k in bucket})


def test_pairs_of_blocks_are_all_listed(monkeypatch):
    monkeypatch.setattr("changefeed.llm.near.BLOCK_PAIRS", 10)
    left, right = np.array([0, 3, 3, 20]), np.array([0, 2, 5, 9])
    got = [(x, y) for xs, ys in block_pairs(left, right) for x, y in zip(xs.tolist(), ys.tolist(), strict=True)]
    assert got == [(x, y) for k in range(3) for x in range(left[k], left[k + 1]) for y in range(right[k], right[k + 1])]


def test_character_runs_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(33)
    texts = ["", *("".join(rng.choices("abé日", k=rng.choice((0, 1, 7, 8, 9, 40, 300)))) for _ in range(80))]
    whole = character_runs(texts, 8)
    monkeypatch.setattr("changefeed.llm.words.PIECE_CHARS", 16)
    assert all((a == b).all() for a, b in zip(character_runs(texts, 8), whole, strict=True))
    assert whole[1].tolist() == [max(len(text) - 7, min(len(text), 1)) for text in texts]
    alone = [character_runs([text], 8)[0] for text in texts]
    assert (np.concatenate(alone) == whole[0]).all()


def test_sketches_mix_each_element_once(monkeypatch):
    """However many rounds it takes to fill all bins, and however many of them go at once."""
    mixed = []
    monkeypatch.setattr(sketch, "mix", lambda x: mixed.append(x.size) or mix(x))
    rng = np.random.default_rng(34)
    sizes = rng.integers(0, 60, 200)
    items = rng.integers(1 << 63, size=sizes.sum(), dtype=np.uint64)
    table = sketches(items, sizes, 80)
    assert sum(mixed) == len(items)
    assert ((table == EMPTY).all(axis=1) == (sizes == 0)).all() and (table[sizes > 0] != EMPTY).all()
    monkeypatch.setattr(sketch, "AT_ONCE", 1)
    assert (sketches(items, sizes, 80) == table).all()


def test_pairs_ruled_out_by_parities_are_no_links(monkeypatch):
    monkeypatch.setattr("changefeed.llm.near.PARITY_CHUNK", 5000)
    rng = np.random.default_rng(35)
    pool = rng.integers(1 << 63, size=8000, dtype=np.uint64) * U(2)
    sets = [pool[:0], pool[:1], pool[1:2], pool]
    for size in (5, 90, 900, 3000):
        for share in (0, 0.02, 0.1, 0.11, 0.12, 0.3, 1):
            gone = int(size * share)
            sets += [pool[gone : gone + size], np.delete(pool[:size], rng.choice(size, gone, replace=False))]
    sets = [np.sort(items) for items in sets]
    assert np.bitwise_count(parities(sets)[:3]).sum(axis=1).tolist() == [0, 1, 1]
    x, y = (places.ravel() for places in np.indices((len(sets), len(sets))))
    for likeness in (lines.LIKENESS, minhash.LIKENESS):
        may = likeness.may_link(sets, sets, x, y)
        links = np.array([likeness.alike(sets[k], sets[m]) for k, m in zip(x, y, strict=True)])
        assert not (links & ~may).any()
        assert links.sum() <= may.sum() < 2 * links.sum()
    assert parities([]).shape == (0, 32)
    none = np.zeros(0, np.int64)
    assert len(lines.LIKENESS.may_link([], [], none, none)) == 0


def test_agreeing_bytes_are_counted():
    rng = np.random.default_rng(36)
    a, b = rng.integers(0, 3, (2, 50, BLOCK_BINS)).astype(np.uint8)
    b[0], b[1] = a[0], a[1] + 1
    assert agreeing(a, b).tolist() == (a == b).sum(axis=1).tolist()
    assert agreeing(a[:0], b[:0]).tolist() == []


def test_lines_are_trimmed_on_either_side(spark):
    bodies = ["some line of text", "", "x"]
    edges = ["", *lines.TRIM, " \t", "\u00a0", "\x1c"]
    text = "\n".join(left + body + right for body in bodies for left in edges for right in edges)
    got = [(r.line_no, r.body) for r in lines.lines_of(spark.createDataFrame([(1, text)], DOC)).collect()]
    assert got == [(at, line.strip(lines.TRIM)) for at, line in enumerate(text.split("\n")) if line.strip(lines.TRIM)]


def test_only_lines_with_something_to_lose_are_trimmed(spark):
    plan = lines.lines_of(spark.createDataFrame([(1, "a")], DOC))._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(BOTH" not in plan.replace("THEN trim(BOTH", "").replace("THEN btrim(", "") and "EndsWith(line" in plan
