import random

from pyspark.sql import functions as F

from turnmill.functions.responses import closes, valid_response
from turnmill.operators import formats, report, turns

ROUND = "sample_id BIGINT, round INT, prompt STRING, response STRING, client STRING, ts DOUBLE, ok BOOLEAN"
ATTEMPT = (
    "sample_id BIGINT, round INT, client STRING, attempt_no INT, prompt STRING, "
    "response STRING, error STRING, ts DOUBLE"
)


def test_response_limits(spark):
    cases = {
        "": False, "123456789": False, "1234567890": True, "  123456789  ": False,
        "x" * 4000: True, "x" * 4001: False, "x" * 3990 + " " * 20: False,
        " 　123456789\u001c": False,
    }
    df = spark.createDataFrame([(c,) for c in cases] + [(None,)], "r STRING")
    got = {r.r: r.v for r in df.select("r", valid_response(F.col("r")).alias("v")).collect()}
    assert got == {**cases, None: False}


def test_closing(spark):
    cases = [
        ("We are Finished. Goodbye to all of you", 1, True),
        ("好的，已完成，谢谢您的耐心等待与支持配合", 1, True),
        ("That's ALL there is to be said on it", 1, True),
        ("short one here", 2, False),
        ("short one here", 3, True),
        ("long enough to go on with", 9, False),
    ]
    df = spark.createDataFrame(cases, "r STRING, n INT, want BOOLEAN")
    assert df.filter(closes(F.col("r"), F.col("n")) != F.col("want")).count() == 0


def python_history(rounds, max_rounds=10):
    """Independent model: walk the rounds of one sample."""
    kept = []
    for no, ok, text in sorted(rounds):
        if no > max_rounds or not ok:
            break
        if not (text and len(text.strip()) >= 10 and len(text) <= 4000):
            continue
        kept.append(no)
        low = text.lower()
        if any(w in low for w in ("that's all", "no more", "finished", "完成", "结束")):
            break
        if len(kept) >= 3 and len(text.strip()) < 20:
            break
    return kept


def test_history_against_model(spark):
    rng = random.Random(1)
    texts = ["x" * 30, "y" * 15, "tiny", "", "we are finished with this one", "z" * 4001, None]
    rows, want = [], {}
    for s in range(300):
        rounds = [
            (no, rng.random() > 0.1, rng.choices(texts, [8, 4, 1, 1, 1, 1, 1])[0])
            for no in range(1, rng.randint(2, 13))
        ]
        want[s] = python_history(rounds)
        rows += [(s, no, "p", t if ok else None, "claude", float(no), ok) for no, ok, t in rounds]
    rng.shuffle(rows)
    got = {s: [] for s in want}
    for r in turns.assemble_history(spark.createDataFrame(rows, ROUND)).collect():
        got[r.sample_id].append(r.round)
    assert {s: sorted(v) for s, v in got.items()} == want


def attempt(sample, client, no, error=None, round_no=1, ts=0.0):
    text = f"{client} answer number {no}"
    return (sample, round_no, client, no, "p", None if error else text, error, ts)


def test_failover(spark):
    rows = [attempt(1, "claude", i, "down") for i in (1, 2, 3)]
    rows += [attempt(1, "gemini", 1), attempt(1, "openai", 1)]
    rows += [attempt(2, c, i, "down") for c in turns.CLIENTS for i in (1, 2, 3)]
    rows += [attempt(2, c, 4) for c in turns.CLIENTS]
    rows += [attempt(3, "claude", 1, "down"), attempt(3, "claude", 2), attempt(3, "openai", 1)]
    rows += [attempt(4, "unknown", 1)]
    df = spark.createDataFrame(rows, ATTEMPT)
    got = {r.sample_id: r for r in turns.first_success(df).collect()}
    assert {s: r.response for s, r in got.items()} == {
        1: "gemini answer number 1",
        2: None,
        3: "claude answer number 2",
        4: None,
    }
    assert [got[s].ok for s in (1, 2, 3, 4)] == [True, False, True, False]
    chosen = turns.first_success(df, chosen=F.lit("openai")).collect()
    assert {r.sample_id: r.client for r in chosen} == {1: "openai", 2: None, 3: "openai", 4: None}
    prompts = spark.createDataFrame([(i, "p") for i in range(1, 6)], "sample_id BIGINT, prompt STRING")
    out = {r.sample_id: (r.response, r.client) for r in
           turns.batch_responses(prompts, turns.first_success(df)).collect()}
    assert out[2] == out[5] == ("", "failed") and out[3][1] == "claude"


def test_preferred_client(spark):
    def pick(active, wanted=None):
        col = turns.preferred_client(F.array(*[F.lit(a) for a in active]), wanted)
        return spark.range(1).select(col).first()[0]

    assert pick(["claude", "openai"]) == "claude"
    assert pick(["gemini", "openai"], ["gpt-4", "claude-3"]) == "openai"
    assert pick(["gemini"], ["gpt-4"]) == "gemini"


def test_results_records_and_counts(spark):
    good = [(1, 1, "claude", 1, "p1", "a" * 30, None, 5.0), (1, 2, "gemini", 1, "p2", "b" * 30, None, 9.0)]
    bad = [(2, 1, "claude", 1, "p1", "tiny", None, 1.0), (3, 1, "claude", 1, "p1", None, "down", 1.0)]
    attempts = spark.createDataFrame(good + bad, ATTEMPT)
    samples = spark.createDataFrame(
        [(i, '{"q":1}', "train" if i < 3 else "test") for i in (1, 2, 3, 4)],
        "sample_id BIGINT, original_data STRING, split STRING",
    )
    history = turns.assemble_history(turns.first_success(attempts, ["claude", "gemini"]))
    results = turns.result_rows(samples, attempts, history)
    by_id = {r.sample_id: r for r in results.collect()}
    assert [by_id[i].success for i in (1, 2, 3, 4)] == [True, False, False, False]
    assert (by_id[1].processing_time, by_id[1].api_client_used) == (4.0, "gemini")
    assert (by_id[2].processing_time, by_id[2].api_client_used) == (0.0, "")
    assert by_id[2].error_message == turns.VALIDATION_ERROR and by_id[2].turns == []
    assert {r.sample_id: r.valid for r in
            turns.conversation_validity(samples, history).collect()} == {1: True, 2: False, 3: False, 4: False}
    lists = turns.batch_conversations(samples.select("sample_id"), history).collect()
    assert {r.sample_id: len(r.turns) for r in lists} == {1: 2, 2: 0, 3: 0, 4: 0}

    record = formats.training_records(results).collect()
    assert len(record) == 1 and record[0].original_data == '{"q":1}'
    assert [c.instruction for c in record[0].conversations] == ["p1", "p2"]
    assert record[0].conversations[1].metadata.asDict() == {
        "round": 2, "api_client": "gemini", "timestamp": 9.0,
    }
    assert record[0].generation_metadata.num_turns == 2

    counts = report.generation_metadata(results).first()
    assert tuple(counts) == (2, 1, 2, 0)
    assert tuple(report.progress_statistics(results).first()) == (4, 3, 4, 1)
    use = {r.client: (r.request_count, r.last_request_time) for r in
           turns.client_statistics(attempts).collect()}
    assert use == {"claude": (3, 5.0), "gemini": (1, 9.0), "openai": (0, 0.0)}


def test_flood_of_attempts_for_one_round(spark):
    flood = spark.range(50_000).select(
        F.lit(1).cast("bigint").alias("sample_id"), F.lit(1).alias("round"),
        F.lit("claude").alias("client"), F.lit(2).alias("attempt_no"), F.lit("p").alias("prompt"),
        F.lit("late but long enough").alias("response"), F.lit(None).cast("string").alias("error"),
        F.col("id").cast("double").alias("ts"),
    )
    one = spark.createDataFrame([attempt(1, "claude", 1)], ATTEMPT)
    won = turns.first_success(flood.unionByName(one)).collect()
    assert [r.response for r in won] == ["claude answer number 1"]
