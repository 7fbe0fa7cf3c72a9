import random

import pytest

from changefeed.operators import wars
from pyspark.sql import functions as F

from changefeed import schemas
from changefeed.operators.wars import USED, _positions, _sort_tasks, edit_wars
from tests.brute import wars as brute_wars

T0 = 1700000000


def story(text, wiki="w", page="P", kinds=None):
    """`A0 Bb30` is an edit by A at second 0 and one by bot B at second 30."""
    rows = []
    for i, word in enumerate(text.split()):
        user, second = word.rstrip("0123456789"), int(word.lstrip("ABCDXb"))
        is_bot = user.endswith("b")
        kind = kinds[i] if kinds else "edit"
        rows.append((wiki, page, user.rstrip("b"), is_bot, 10 + i, kind, T0 + second, i))
    return rows


def found(df):
    return sorted(
        tuple(row)
        for row in df.select(
            "wiki", "title", "reverter", "opponent", F.unix_seconds("started_at"), F.unix_seconds("ended_at"),
            "seconds_elapsed", "swing_bytes",
        ).collect()
    )


STORIES = {
    "A0 B30 A60": 1,
    "A0 B30 A60 B90 A120": 1,
    "A0 B30 A60 B90 A120 B150": 2,
    "A0 C10 B30 A60": 0,
    "A0 Xb10 B30 A60": 0,
    "A0 Bb30 A60": 0,
    "Ab0 B30 A60": 0,
    "A0 B30 Ab60": 1,
    "A0 B300 A599": 1,
    "A0 B300 A600": 0,
    "A0 A10 B20 A30": 1,
    "A5 B5 A5": 1,
    "A0 B30": 0,
}


@pytest.mark.parametrize("limits", [{}, {"hot_page_edits": 1, "slice_edits": 4}])
def test_stories(edits, limits):
    """Each story is a wiki of its own."""
    rows = [row for text in STORIES for row in story(text, wiki=text)]
    got = found(edit_wars(edits(rows), 600, **limits))
    assert {text: sum(match[0] == text for match in got) for text in STORIES} == STORIES
    assert got == brute_wars(rows, 600)


def test_match_columns(edits):
    df = edit_wars(edits(story("A0 B30 A60")))
    assert [(n, t.upper()) for n, t in df.dtypes] == schemas.fields(schemas.EDIT_WAR)
    assert found(df) == [("w", "P", "A", "B", T0, T0 + 60, 60, 11 + 12)]


def test_pages_are_apart(edits):
    rows = [story("A0")[0], story("B30", page="Q")[0], story("A60")[0]]
    assert found(edit_wars(edits(rows))) == []


def test_every_edit_type_takes_part(edits):
    rows = story("A0 B30 A60", kinds=["edit", "log", "categorize"])
    assert len(found(edit_wars(edits(rows)))) == 1


def test_edits_without_event_time_are_no_neighbours(edits):
    rows = edits(story("A0 B30 C40 A60")).withColumn(
        "event_time", F.when(F.col("user") != "C", F.col("event_time"))
    )
    assert len(found(edit_wars(rows))) == 1


SHAPES = [
    (1, 2, 0.0, [0, 1]),
    (2, 2, 0.03, [0, 0, 1]),
    (3, 3, 0.05, [0, 1, 599, 600, 601]),
    (6, 2, 0.1, [0, 1, 200, 300]),
    (3, 4, 0.0, [0, 5]),
]


@pytest.mark.parametrize(
    "limits", [{}, {"hot_page_edits": 100, "slice_edits": 4}, {"hot_page_edits": 400, "slice_edits": 64}]
)
def test_against_plain_python(edits, limits):
    rows = []
    for shape, (pages, users, bots, gaps) in enumerate(SHAPES):
        rnd = random.Random(shape)
        second = T0
        for i in range(1500):
            second += rnd.choice(gaps)
            page, user = f"P{int(pages * rnd.random() ** 3)}", f"u{rnd.randrange(users)}"
            rows.append((f"shape{shape}", page, user, rnd.random() < bots, rnd.randrange(-50, 50), "edit", second, i))
    want = brute_wars(rows, 600)
    assert {match[0] for match in want} == {f"shape{shape}" for shape in range(len(SHAPES))}
    random.Random(0).shuffle(rows)
    assert found(edit_wars(edits(rows), 600, **limits)) == want


def test_long_alternation_over_many_slices(edits):
    """No slice settles by itself here: the choice depends on the very first edit."""
    lengths = (9, 10, 11, 40)
    rows = [
        ("w", f"P{length}", "AB"[i % 2], False, 1, "edit", T0 + i, i) for length in lengths for i in range(length)
    ]
    got = found(edit_wars(edits(rows), 600, hot_page_edits=1, slice_edits=4))
    assert got == brute_wars(rows, 600)
    assert len(got) == sum(length // 3 for length in lengths)


def test_hot_page_beside_small_ones(edits):
    rnd = random.Random(7)
    rows = [
        ("w", "hot" if rnd.random() < 0.4 else f"P{rnd.randrange(200)}", f"u{rnd.randrange(2)}", False, 1, "edit", T0 + i // 3, i)
        for i in range(3000)
    ]
    assert found(edit_wars(edits(rows), 600, hot_page_edits=100, slice_edits=50)) == brute_wars(rows, 600)


def test_one_shuffle_of_the_edits(edits):
    plan = edit_wars(edits(story("A0 B30 A60")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_chains_of_unsettled_slices(spark):
    """Ten thousand slices of which none settles the state, some missing, composed in groups."""
    rng = random.Random(8)
    maps = [(0, 1, 2), (1, 2, 0), (2, 0, 1), (0, 2, 1), (1, 0, 2), (2, 1, 0), (0, 0, 1)]
    rows, expected = [], {}
    for page, count, shares in (("long", 10_000, maps[:6]), ("short", 70, maps), (None, 9, maps)):
        state = 0
        for at in range(count):
            if rng.random() < 0.05:
                continue
            ends = rng.choice(shares)
            rows.append((page, "T", at, 5, *ends))
            expected[page, at] = state
            state = ends[state]
    worked = spark.createDataFrame(rows, "wiki string, title string, slice bigint, pos bigint, distance_0 int, distance_1 int, distance_2 int")
    for fan in (4, 64):
        got = wars._entry_distances(worked, [*wars.PAGE, "slice"], fan).collect()
        assert {(r.wiki, r.slice): r.entry for r in got} == expected
    assert wars._entry_distances(worked.limit(0), [*wars.PAGE, "slice"]).collect() == []


def test_small_slices_do_not_multiply_sort_tasks(spark, edits):
    """Found by the review: tasks and files of the sort grew with the edits over a slice of any smallness."""
    rows = [("w", f"P{n % 2}", "A", False, 1, "edit", n // 3, n) for n in range(1000)]
    placed = _positions(edits(rows).select(*USED), len(rows), 4)
    assert len(placed.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = sorted((row["pos"], row["title"], row["offset"]) for row in placed.collect())
    assert found == [(pos, *place) for pos, place in enumerate(sorted((row[1], row[7]) for row in rows))]
    assert _sort_tasks(40_000_000, 40, 4) == 10
