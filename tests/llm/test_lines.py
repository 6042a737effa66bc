"""Repeats of one and two lines against plain Python."""

import random

import pytest

from turnmill.llm import line_dedup

PASSAGE = " ".join(f"word{i}" for i in range(50))
HALF = " ".join(f"half{i}" for i in range(25))


def plain(rows, run=3, words=50):
    """Line numbers that go: every run of up to ``run`` lines that counts and occurs earlier."""
    seen, gone = set(), [set() for _ in rows]
    solid = [[(i, x.strip()) for i, x in enumerate(t.split("\n")) if x.strip()] for t in rows]
    for lines, out in zip(solid, gone):
        for at in range(len(lines)):
            for size in range(1, min(run, len(lines) - at) + 1):
                part = lines[at : at + size]
                key = tuple(x for _, x in part)
                long = sum(len(x.split()) for x in key) >= words
                if key in seen and (size == run or long or size == len(lines)):
                    out |= {i for i, _ in part}
                seen.add(key)
    return gone


def removed(spark, rows, **options):
    docs = spark.createDataFrame(list(enumerate(rows)), "rid BIGINT, text STRING").selectExpr("rid", "rid AS doc_id", "text")
    found = {r["rid"]: set(r["gone"]) for r in line_dedup.repeated_lines(docs, **options).collect()}
    return [found.get(i, set()) for i in range(len(rows))]


@pytest.mark.parametrize(
    "rows, gone",
    [
        (["one", "one"], [set(), {0}]),  # a whole document of one line
        (["one\n\ntwo", " one \ntwo\n"], [set(), {0, 1}]),  # of two lines
        (["a\none\ntwo\nb", "one\ntwo", "two"], [set(), {0, 1}, {0}]),  # inside a longer one
        (["one", "a\none\nb"], [set(), set()]),  # a short line among others is no repeat
        ([f"a\n{PASSAGE}\nb", f"c\n{PASSAGE}\nd"], [set(), {1}]),  # other neighbours
        ([f"a\n{HALF}\n{HALF} x\nb", f"c\n{HALF}\n{HALF} x\nd", f"e\n{HALF}\nf"], [set(), {1, 2}, set()]),
        ([PASSAGE[:-7], f"x\n{PASSAGE[:-7]}\ny"], [set(), set()]),  # 49 words
        (["", "", "\n", "\n"], [set()] * 4),
    ],
)
def test_short_runs(spark, rows, gone):
    assert plain(rows) == gone
    assert removed(spark, rows) == gone


def test_runs_equal_plain_python(spark, monkeypatch):
    rng = random.Random(6)
    kinds = [f"{c} " * n for c in "abcdef" for n in (1, 2, 4, 30, 55)] + [""]
    rows = ["\n".join(rng.choice(kinds) for _ in range(rng.choice([1, 1, 2, 2, 3, 5, 9]))) for _ in range(150)]
    want = plain(rows)
    assert removed(spark, rows) == want and sum(map(len, want)) > 100
    monkeypatch.setattr(line_dedup, "SLOTS", 64)  # a full sieve costs, it does not change rows
    assert removed(spark, rows) == want
    assert removed(spark, rows, words=None) == [
        g & three for g, three in zip(want, plain_three(rows))
    ]


def plain_three(rows):
    seen, gone = set(), [set() for _ in rows]
    for text, out in zip(rows, gone):
        lines = [(i, x.strip()) for i, x in enumerate(text.split("\n")) if x.strip()]
        for part in zip(lines, lines[1:], lines[2:]):
            key = tuple(x for _, x in part)
            if key in seen:
                out |= {i for i, _ in part}
            seen.add(key)
    return gone


def test_long_texts_are_linear(spark):
    """Two equal texts of 80,000 lines, and one with a repeat inside."""
    import time

    lines = [f"line {i} of a long text" for i in range(80_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines)), (3, "\n".join([*lines[:5], "new"] * 2))]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    start = time.perf_counter()
    found = {r["doc_id"]: (r["removed_lines"], r["text"]) for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert time.perf_counter() - start < 20
    assert found[1] == (0, rows[0][1]) and found[2] == (80_000, "")
    assert found[3] == (11, "new")
