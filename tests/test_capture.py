import random

import pytest

from changefeed.sources import capture


@pytest.fixture
def blocks(spark, tmp_path):
    def read(*texts):
        for i, text in enumerate(texts):
            (tmp_path / f"capture-{i:03}.txt").write_bytes(text.encode())
        return capture.sse_blocks(capture.read_capture(spark, str(tmp_path)))

    return read


def events_of(blocks_df):
    rows = capture.sse_events(blocks_df).orderBy("file", "block_no").collect()
    return [(row["event"], row["data"], row["id"], row["retry_ms"]) for row in rows]


def message(data, id=None, retry=None, event="message"):
    return (event, data, id, retry)


CASES = [
    ('event: change\ndata: {"page": "Moss", "n": 3}\n\n', [message('{"page": "Moss", "n": 3}', event="change")]),
    (": still here\n\n: still here\n\n", []),
    ("data: upper half\ndata: lower half\n\n", [message("upper half\nlower half")]),
    ("data:   indented\n\n", [message("  indented")]),
    ("data:tight\n\n", [message("tight")]),
    ("id: 1700-4\n\n", []),
    ("id: k7\ndata: moss\n\ndata: fern\n\n", [message("moss", "k7"), message("fern")]),
    ("colour: green\ndata: moss\n\n", [message("moss")]),
    ("retry: 250\ndata: moss\n\n", [message("moss", retry=250)]),
    ("retry: later\ndata: moss\n\n", [message("moss")]),
    ("retry: 31\nretry: never\ndata: moss\n\n", [message("moss", retry=31)]),
    ("data: moss\r\n\r\n", [message("moss")]),
    ("data: cut off", []),
    ("data: cut off\n", []),
    ("data: moss\n\ndata: cut off\n", [message("moss")]),
    ("\n\n\ndata: moss\n\n", [message("moss")]),
    ("event: one\nevent: two\nid: 8\nid: 9\ndata: moss\n\n", [message("moss", "9", event="two")]),
    ("event: lost\n\ndata: moss\n\n", [message("moss")]),
    ("data\n\n", []),
    ("data\ndata: fern\n\n", [message("\nfern")]),
    ("data: 12:30: noon\n\n", [message("12:30: noon")]),
    ("id\ndata: moss\n\n", [message("moss", "")]),
]


def test_blocks(blocks):
    """Each case is a capture file of its own."""
    rows = capture.sse_events(blocks(*[text for text, _ in CASES])).orderBy("block_no").collect()
    for i, (text, expected) in enumerate(CASES):
        got = [tuple(row)[2:] for row in rows if row["file"].endswith(f"capture-{i:03}.txt")]
        assert got == expected, text


@pytest.mark.parametrize(
    "texts, position",
    [
        (["id: 1700-4\ndata: moss\n\n"], "1700-4"),
        (["id: 55\n\n"], "55"),
        (["id: k7\ndata: moss\n\ndata: fern\n\n"], "k7"),
        (["id: k7\ndata: moss\n\nid:\ndata: fern\n\n"], "k7"),
        (["id: k1\ndata: moss\n\n", "id: k2\ndata: fern\n\n", "data: reed\n\n"], "k2"),
        (["id: k1\ndata: moss\n\nid: k2\ndata: cut off\n"], "k1"),
        (["data: moss\n\n"], None),
    ],
)
def test_resume_position(blocks, texts, position):
    assert capture.resume_position(blocks(*texts)).first()["last_event_id"] == position


@pytest.mark.parametrize("split_bytes", [23, 64, 1000])
def test_blocks_across_file_splits(spark, blocks, split_bytes):
    """A file read in many splits gives the same blocks as one read whole."""
    rnd = random.Random(split_bytes)
    text, want = "", []
    for i in range(120):
        end = rnd.choice(["\n", "\r\n"])
        lines = [f"id: {i}"] + [f"data: {'x' * rnd.randrange(1, 60)}" for _ in range(rnd.randrange(4))]
        if rnd.random() < 0.3:
            lines.insert(1, ":ok")
        text += "".join(line + end for line in lines) + end * rnd.choice([1, 1, 2])
        data = "\n".join(line[6:] for line in lines if line.startswith("data"))
        if data:
            want.append(message(data, str(i)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = blocks(text + "data: unfinished\n")
        assert events_of(read) == want
        assert capture.resume_position(read).first()["last_event_id"] == "119"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_unclosed_lines_are_not_gathered(spark, blocks):
    """A capture without a closing blank line gives nothing, and its lines are left out row by row."""
    read = blocks("data: moss\n\n" + "data: x\n" * 1000)
    assert events_of(read) == [message("moss")]
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "file_blanks" in plan and plan.index("collect_list") < plan.index("file_blanks")
