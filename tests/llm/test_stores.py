"""Embeddings, packing, archives, the pipeline and the queries."""

import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from changefeed.llm import lattice, packing, warc
from changefeed.llm.oracle import ORACLE_SQL
from changefeed.llm.queries import QUERIES
from changefeed.session import scratch_table
from checks.compare import as_bag, expected, tables
from tests.llm import brute

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
with_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

DOC = "doc_id bigint, text string"


# -- embeddings ----------------------------------------------------------------------------


def units(rng, n, d):
    x = rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_decoded_points_are_nearest():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(400, 8)) * 3
    point = lattice.decode(y)
    roots = lattice.roots()
    assert len(roots) == 240 and np.allclose((roots**2).sum(axis=1), 2)
    assert (np.allclose(point * 2, np.rint(point * 2))) and not (point.sum(axis=1) % 2).any()
    own = ((y - point) ** 2).sum(axis=1)
    around = ((y[:, None, :] - point[:, None, :] - roots[None]) ** 2).sum(axis=2).min(axis=1)
    assert (own <= around + 1e-9).all() and own.max() <= 1 + 1e-9


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    x = units(rng, 3000, 64)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * z
    a, b = lattice.cell_keys(x), lattice.cell_keys(y)
    met = (a[:, :, 0] == b[:, :, 0]) | (a[:, :, :1] == b[:, :, 1:]).any(axis=2) | (b[:, :, :1] == a[:, :, 1:]).any(axis=2)
    assert met.any(axis=1).mean() > 0.985


def links(vectors):
    """(links per vector, smallest id reachable) by comparing all pairs."""
    ids = list(vectors)
    x = np.array([vectors[i] for i in ids], float)
    norm = np.linalg.norm(x, axis=1)
    near = (x @ x.T) / norm[:, None] / norm[None, :] >= lattice.COSINE
    np.fill_diagonal(near, False)
    sets = {i: frozenset([(min(i, j), max(i, j)) for j in np.array(ids)[row]] + [(i, i)]) for i, row in zip(ids, near, strict=True)}
    return {i: len(s) - 1 for i, s in sets.items()}, brute.components(sets, 0.0001)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors(spark, monkeypatch, kind):
    monkeypatch.setattr("changefeed.llm.lattice.BLOCK", 16)
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for base in units(rng, 40, 16):
        for spread in rng.choice([0.0, 0.02, 0.06], size=rng.integers(1, 12)):
            rows.append((at, (base + rng.normal(size=16) * spread).astype("f4") * rng.integers(1, 5)))
            at += 1
    rows += [(at + k, rows[0][1]) for k in range(60)]
    vectors = {i: v for i, v in rows}
    n_links, roots = links(vectors)
    bad = [(9001, None), (9002, [0.0] * 16), (9003, [1.0, None]), (9004, [float("nan")] * 16), (9005, []), (9006, [float("inf")] * 16), (None, [1.0] * 16)]
    bad += [(9007, [2.0, 1.0]), (9008, [4.0, 2.0])]
    data = [(i, [float(c) for c in v], 1) for i, v in rows] + [(i, v, 1) for i, v in bad]
    df = spark.createDataFrame(data, f"vec_id bigint, embedding array<{kind}>, copies int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(df).collect()}
    found = sum(got[i][0] for i in vectors)
    assert found >= 0.99 * sum(n_links.values()) and all(got[i][0] <= n_links[i] for i in vectors)
    exact = [i for i in vectors if all(got[j][0] == n_links[j] for j in vectors if roots[j] == roots[i])]
    assert len(exact) > 0.95 * len(vectors) and all(got[i][1:] == (roots[i], roots[i] == i) for i in exact)
    assert all(got[i] == (0, i, True) for i in range(9001, 9007)) and got[None] == (0, None, True)
    assert got[9007] == (1, 9007, True) and got[9008] == (1, 9007, False)
    assert lattice.near_vectors(df.where("vec_id < 0")).collect() == []


# -- packing -------------------------------------------------------------------------------


def test_differencing_keeps_every_item():
    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.choice((512, 256, 128, rng.randint(1, 127))) for _ in range(rng.randint(0, 120))]
        windows = packing.balanced(sizes)
        assert sorted(at for window in windows for at in window) == list(range(len(sizes)))
        loads = [sum(sizes[at] for at in window) for window in windows]
        assert all(load <= packing.WINDOW for load in loads)
        if sum(sizes) > 40 * packing.WINDOW:
            assert len(windows) <= 1.03 * sum(sizes) / packing.WINDOW + 1


def test_differencing_raises_the_count():
    assert len(packing.balanced([700, 700, 600])) == 3
    assert len(packing.balanced([512, 512, 512, 512])) == 2
    assert packing.balanced([]) == []


@pytest.fixture(scope="module")
def tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_tokenizers(tokens):
    import public_tokenizers

    fast = packing.Tokens(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(5)
    texts = ["".join(rng.choice(" a\n'sé1.\x1c日　<|x") for _ in range(40)) for _ in range(800)]
    texts += ["", " ", "a  b", "<|endoftext|> a", "it's 'll  x \n y", "Éa ßü ñ 12 3"]
    for text in texts:
        assert np.frombuffer(fast.of(text), "<u4").tolist() == tokens(text)[:-1], repr(text)


def test_packing_round_trip(spark, tokens):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choices(["alpha", "beta", "Zürich", "x1", "日本"], k=rng.randint(0, 900))), "y") for k in range(150)]
    rows += [(200, None, "y"), (201, "", "y"), (202, "long text " * 30_000, "y"), (None, "no id", "y"), (203, "twice", "y"), (203, "twice", "y")]
    docs = spark.createDataFrame(rows, DOC + ", start string").repartition(3)
    pieces = packing.pack(docs, with_ids=True).collect()
    texts = {i: text for i, text, _ in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert len(p.ids) == p.length and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == texts.keys()
    for doc_id, parts in by_doc.items():
        ids = tokens(texts[doc_id])
        parts = sorted(parts, key=lambda p: p.start)
        whole = [x for p in parts for x in p.ids]
        assert whole == (ids if doc_id != 203 else [x for part in parts for x in part.ids])
        assert all(p.doc_tokens == len(ids) for p in parts)
        if doc_id != 203:
            assert [p.start for p in parts] == list(np.cumsum([0, *(p.length for p in parts)])[:-1])
        else:
            assert len(parts) == 2 and all(list(p.ids) == ids for p in parts)
    for parts in by_sequence.values():
        parts = sorted(parts, key=lambda p: p.offset)
        assert [p.offset for p in parts] == list(np.cumsum([0, *(p.length for p in parts)])[:-1])
        assert sum(p.length for p in parts) <= packing.WINDOW
    assert packing.pack(docs.where("doc_id > 999")).collect() == []


@with_tables
def test_little_padding(spark):
    pieces = packing.pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    loads = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.sum("n"), F.count("*")).first()
    assert 1 - loads[0] / (packing.WINDOW * loads[1]) < 0.02


# -- archives ------------------------------------------------------------------------------


def test_archive_round_trip(spark):
    rng = random.Random(7)
    same, small, long = "<p>same é</p>" * 12, "<p/>", "".join(rng.choices("abcdefgh <>/\n", k=40_000))
    rows = [(k, f"http://a/{k}", "".join(rng.choices("abc<>é\r\n", k=rng.randint(0, 900))), 1) for k in range(60)]
    rows += [(100 + k, "http://b/ x\n", same, 1) for k in range(30)] + [(200, None, small, 1), (201, "u", small, 1)]
    rows += [(202, "u", None, 1), (203, "u", "", 1), (204, "u", long, 1), (None, "u", same, 1), (100, "again", same, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int").repartition(3)
    folder = scratch_table(spark, "archive")
    index = warc.write_archive(pages, folder, frame_bytes=3000, bundle_bytes=4000)
    assert index.count() == len(rows)
    got = warc.read_archive(spark, folder, with_payload=True).collect()
    assert len(got) == len(rows)
    html = {i: text or "" for i, _, text, _ in rows}
    for r in got:
        data = html[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        revisit = data == same.encode() and r.page_id != 100
        assert (r.record_type, r.refers_to) == (("revisit", 100) if revisit else ("response", None))
        assert r.payload == (None if revisit else data)

    # every bundle is a plain Zstandard file, and the index leads into its frames
    files, path = pafs.FileSystem.from_uri(f"{folder}/data")
    names = {r.bundle for r in index.collect()}
    assert len(names) > 1
    for name in names:
        with files.open_input_file(f"{path}/{name}") as file:
            frames = warc.read_seek_table(file)
            data = file.read_at(file.size(), 0)
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert b"".join(zstandard.ZstdDecompressor().decompress(data[at : at + n]) for at, n in frames) == whole
    wanted = spark.createDataFrame([("<urn:x-page:204>",), ("<urn:x-page:7>",), ("<urn:x-page:7777>",)], "record_id string")
    found = {r.page_id: r.payload for r in warc.read_records(spark, folder, wanted).collect()}
    assert found == {204: long.encode(), 7: html[7].encode()}


def test_empty_archive(spark):
    folder = scratch_table(spark, "archive")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.write_archive(pages, folder).collect() == []
    assert warc.read_archive(spark, folder).collect() == []


def test_damage_is_noticed():
    kind, record = warc.record_bytes(1, "http://a", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    fields, block, end = warc.parse_record(record)
    assert (kind, end) == ("response", len(record))
    assert warc.to_rows([(fields, block)], True).column("payload").to_pylist() == [b"payload"]
    with pytest.raises(ValueError):
        warc.to_rows([(fields, block.replace(b"payload", b"changed"))], True)
    with pytest.raises(ValueError):
        warc.parse_record(record[:-4])


# -- queries and the pipeline --------------------------------------------------------------


def test_names():
    names = [f"op{n}_" for n in range(1, 11)]
    assert all(sum(q.startswith(name) for q in QUERIES) == 1 for name in names)
    assert QUERIES.keys() | {"pipeline"} <= entry_point.queries().keys()
    assert ORACLE_SQL.keys() <= entry_point.oracle_sql().keys()


@with_tables
@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert as_bag(df.columns, df.collect()) == expected(tables(SF_DIR), ORACLE_SQL[name])


@with_tables
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


@with_tables
def test_pipeline(spark, tokens):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        path = scratch_table(spark, f"test-{name}")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == documents.columns
    rows = {name: {r.doc_id: r.text for r in df.collect()} for name, df in seen.items() if name != "packing"}
    before = {r.doc_id: r.text for r in documents.collect()}
    assert rows["toxicity"].items() <= before.items()
    kept = brute.line_classes(list(rows["toxicity"].items()))
    for doc_id, text in rows["toxicity"].items():
        lines = (text or "").split("\n")
        left = "\n".join(line for at, line in enumerate(lines) if kept.get((doc_id, at), (doc_id, at)) == (doc_id, at))
        assert rows["line_dedup"].get(doc_id, "").strip() == left.strip()
    sets = {i: brute.word_shingles(t) for i, t in rows["line_dedup"].items()}
    roots = brute.components({i: s for i, s in sets.items() if s}, 75)
    assert rows["near_dedup"].keys() == {i for i in sets if roots.get(i, i) == i}
    assert rows["decontamination"].items() <= rows["near_dedup"].items()
    pieces = seen["packing"].collect()
    assert {p.doc_id for p in pieces} == rows["decontamination"].keys()
    whole = {}
    for p in sorted(pieces, key=lambda p: p.start):
        whole.setdefault(p.doc_id, []).extend(p.ids)
    assert whole == {i: tokens(t) for i, t in rows["decontamination"].items()}
