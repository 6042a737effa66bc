"""Conversations from attempts that keep arriving."""

import pytest

from turnmill.operators.turns import assemble_history, collect_turns, first_success
from turnmill.streaming import attempts

SCHEMA = (
    "sample_id BIGINT, round INT, client STRING, attempt_no INT, prompt STRING, response STRING, "
    "error STRING, ts DOUBLE"
)


def answer(n):
    return f"an answer that is long enough, number {n}"


def row(sample, number, ts, client="claude", attempt=1, response=None, error=None, prompt="why?"):
    return (sample, number, client, attempt, prompt, response or answer(ts), error, float(ts))


@pytest.fixture
def feed(spark, tmp_path):
    """Lets rows arrive, runs the stream, and gives every sample's state."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        attempts.run_new_attempts(stream, out, str(tmp_path / "at"), late_seconds=10, idle_seconds=20)
        return {r.sample_id: r for r in attempts.latest_conversations(spark, out).collect()}

    return run


def turns(state):
    return None if state.turns is None else [(t.round, t.client, t.ts) for t in state.turns]


def test_better_attempts_replace_worse_ones(feed):
    first = feed([row(1, 1, 5, "openai"), row(1, 2, 6, error="timeout"), row(2, 1, 5, error="timeout")])
    assert turns(first[1]) == [(1, "openai", 5.0)]
    assert turns(first[2]) is None
    # The second round succeeds at last; the first has a client that goes before.
    later = feed([row(1, 2, 7, attempt=2), row(1, 1, 8, "gemini", 3), row(1, 1, 8, "claude", 4)])
    assert turns(later[1]) == [(1, "gemini", 8.0), (2, "claude", 7.0)]
    assert not later[1].closed


def test_samples_close_and_stay_closed(feed):
    feed([row(1, 1, 0), row(2, 1, 0)])
    # The watermark is at 40 after this: both have been idle for more than 20 seconds.
    closed = feed([row(3, 1, 50)])
    assert [closed[i].closed for i in (1, 2, 3)] == [True, True, False]
    assert turns(closed[1]) == [(1, "claude", 0.0)]
    # One attempt is behind the watermark, one is not: the closed form stands.
    after = feed([row(1, 2, 30), row(2, 2, 55), row(3, 2, 52)])
    assert [turns(after[i]) for i in (1, 2)] == [[(1, "claude", 0.0)], [(1, "claude", 0.0)]]
    assert turns(after[3]) == [(1, "claude", 50.0), (2, "claude", 52.0)]


def test_late_attempts_within_the_limit_count(feed):
    feed([row(1, 2, 100), row(2, 1, 95)])
    assert turns(feed([row(1, 1, 92)])[1]) == [(1, "claude", 92.0), (2, "claude", 100.0)]
    assert turns(feed([row(1, 3, 60), row(1, 4, 101)])[1]) == [
        (1, "claude", 92.0),
        (2, "claude", 100.0),
        (4, "claude", 101.0),
    ]


def test_nulls_ties_and_repeats(spark, feed):
    rows = [
        (None, 1, "claude", 1, "p", answer(1), None, 1.0),
        (1, None, "claude", 1, "p", answer(1), None, 1.0),
        (1, 1, "claude", 1, "p", answer(1), None, None),
        (1, 1, None, 1, "p", answer(1), None, 1.0),
        (1, 1, "claude", None, None, answer(1), None, 1.0),
        (1, 1, "claude", 1, "q", answer(2), None, 2.0),
        (1, 1, "claude", 1, None, answer(2), None, 3.0),
        (1, 1, "claude", 1, "z", answer(1), "down", 1.0),
        (1, 2, "claude", 1, None, None, None, 4.0),
        (1, 3, "claude", 1, None, "", None, 4.0),
        (1, 4, "claude", 1, None, "long " * 200, None, 4.0),
        (1, 11, "claude", 1, None, answer(1), None, 4.0),
    ]
    got = feed(rows + rows)[1]
    batch = spark.createDataFrame(rows, SCHEMA).filter(
        "sample_id IS NOT NULL AND round IS NOT NULL AND ts IS NOT NULL"
    )
    want = collect_turns(assemble_history(first_success(batch))).first()
    assert [tuple(t) for t in got.turns] == [tuple(t) for t in want.turns]
    assert [t.round for t in got.turns] == [1, 4]


def test_nothing_arrives(feed):
    assert feed([]) == {}


def test_a_flood_of_attempts_for_one_sample(spark, feed):
    flood = [row(1, i % 10 + 1, 5, "gemini", i % 3 + 1, answer(i)) for i in range(3000)]
    state = feed(flood + [row(1, 4, 6)])[1]
    batch = spark.createDataFrame(flood + [row(1, 4, 6)], SCHEMA)
    want = assemble_history(first_success(batch)).orderBy("round")
    names = ["round", "prompt", "response", "client", "ts"]
    assert [tuple(t) for t in state.turns] == [tuple(r) for r in want.select(*names).collect()]
