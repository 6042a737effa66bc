"""From an attempts table to conversations and result rows.

``attempts(sample_id, round, client, attempt_no, prompt, response, error, ts)``
holds every call a batch-inference job made. All steps are relational; groups
are bounded by clients x retries and by rounds once attempts are reduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.functions.responses import (
    MAX_ANSWER,
    MIN_ANSWER,
    closes,
    valid_response,
    within_limits,
)
from turnmill.functions.text import hash_pick

# Clients in their order, and the model families they serve.
CLIENTS = ["claude", "gemini", "openai"]
FAMILIES = [("claude", "claude"), ("gemini", "gemini"), ("gpt", "openai")]
MODEL_PREFERENCES = ["claude-3-sonnet-20240229", "gemini-1.5-pro", "gpt-4"]
# Limits and the texts of failed outcomes.
MAX_RETRIES = 3
MAX_ROUNDS = 10
FAILED_CLIENT = "failed"
NO_CLIENT = "none"
VALIDATION_ERROR = "Generated conversation failed validation"

TURN = (
    "array<struct<round:int,prompt:string,response:string,client:string,timestamp:double>>"
)


def preferred_client(active: Column, preferences: list[str] | None = None) -> Column:
    """First preferred model whose client is in the ``active`` array, else its first entry."""
    wanted = []
    for model in preferences if preferences is not None else MODEL_PREFERENCES:
        wanted += [client for family, client in FAMILIES if family in model.lower()]
    choices = [F.when(F.array_contains(active, c), F.lit(c)) for c in wanted]
    return F.coalesce(*choices, F.get(active, F.lit(0)))


def random_client(active: Column, n_active: int, seed: int, *keys: Column) -> Column:
    """A client picked evenly and repeatably per key, to spread the load."""
    return F.element_at(active, hash_pick(n_active, seed, *keys).cast("int") + 1)


def attempt_place(clients: list[str] | None = None, chosen: Column | None = None) -> Column:
    """Place of an attempt's client: the ``chosen`` (by default preferred) one, then list order."""
    listed = F.array(*[F.lit(c) for c in clients or CLIENTS])
    first = chosen if chosen is not None else preferred_client(listed)
    return F.when(F.col("client") == first, 0).otherwise(F.array_position(listed, F.col("client")))


def usable_attempt(clients: list[str] | None = None, max_retries: int = MAX_RETRIES) -> Column:
    """Whether an attempt succeeded and is one that would have been made."""
    return (
        F.col("error").isNull()
        & F.col("client").isin(clients or CLIENTS)
        & F.col("attempt_no").between(1, max_retries)
    )


def first_success(
    attempts: DataFrame,
    clients: list[str] | None = None,
    chosen: Column | None = None,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """The winning attempt of every (sample_id, round).

    The ``chosen`` client goes first (a per-row expression; by default the
    preferred one), then the other active clients in order, each with attempts
    1..max_retries. A round where nothing succeeded has ``ok`` false and NULLs.
    Aggregated map-side, so a flood of attempts for one round is harmless.
    """
    place = attempt_place(clients, chosen).alias("place")
    winner = F.min(
        F.when(
            usable_attempt(clients, max_retries),
            F.struct(place, "attempt_no", "client", "response", "ts"),
        )
    )
    return (
        attempts.groupBy("sample_id", "round")
        .agg(winner.alias("w"), F.max("prompt").alias("prompt"))
        .select(
            "sample_id",
            "round",
            "prompt",
            "w.response",
            "w.client",
            F.col("w.ts").alias("ts"),
            F.col("w").isNotNull().alias("ok"),
        )
    )


def assemble_history(
    rounds: DataFrame,
    max_rounds: int = MAX_ROUNDS,
    low: int = MIN_ANSWER,
    high: int = MAX_ANSWER,
) -> DataFrame:
    """Turns that make up each conversation, one row per kept turn.

    A failed round ends the conversation before it; an invalid response is
    skipped but uses up its round; a closing turn is kept and ends it.
    """
    so_far = Window.partitionBy("sample_id").orderBy("round")
    earlier = so_far.rowsBetween(Window.unboundedPreceding, -1)
    good = F.col("ok") & valid_response(F.col("response"), low, high)
    ends = ~F.col("ok") | (F.col("_good") & closes(F.col("response"), F.col("_turn")))
    return (
        rounds.filter(F.col("round").between(1, max_rounds))
        .withColumn("_good", good)
        .withColumn("_turn", F.count_if(F.col("_good")).over(so_far))
        .withColumn("_ends", ends)
        .withColumn("_over", F.coalesce(F.bool_or("_ends").over(earlier), F.lit(False)))
        .filter(F.col("_good") & ~F.col("_over"))
        .select("sample_id", "round", "prompt", "response", "client", "ts")
    )


def collect_turns(history: DataFrame) -> DataFrame:
    """One row per sample with its turns in round order (at most ``max_rounds``)."""
    turn = F.struct(
        F.col("round").cast("int").alias("round"),
        "prompt",
        "response",
        "client",
        F.col("ts").cast("double").alias("timestamp"),
    )
    return history.groupBy("sample_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def conversation_validity(
    samples: DataFrame, history: DataFrame, low: int = MIN_ANSWER, high: int = MAX_ANSWER
) -> DataFrame:
    """Per sample: at least one turn and every response within the limits."""
    checked = history.groupBy("sample_id").agg(
        F.bool_and(within_limits(F.col("response"), low, high)).alias("valid")
    )
    return samples.select("sample_id").join(checked, "sample_id", "left").select(
        "sample_id", F.coalesce("valid", F.lit(False)).alias("valid")
    )


def client_statistics(attempts: DataFrame, clients: list[str] | None = None) -> DataFrame:
    """Requests and last request time of every active client, unused ones included."""
    active = clients or CLIENTS
    listed = attempts.sparkSession.createDataFrame([(c,) for c in active], "client string")
    used = attempts.groupBy("client").agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    return listed.join(used, "client", "left").select(
        "client",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("request_count"),
        F.coalesce("last", F.lit(0.0)).alias("last_request_time"),
        F.lit(True).alias("available"),
    )


def batch_responses(
    prompts: DataFrame, outcomes: DataFrame, keys: tuple[str, ...] = ("sample_id",)
) -> DataFrame:
    """Every prompt with its response and client; ('', 'failed') where all failed."""
    won = outcomes.select(*keys, "response", "client")
    return prompts.join(won, list(keys), "left").select(
        *[prompts[c] for c in prompts.columns],
        F.coalesce("response", F.lit("")).alias("response"),
        F.coalesce("client", F.lit(FAILED_CLIENT)).alias("client"),
    )


def batch_conversations(prompts: DataFrame, history: DataFrame) -> DataFrame:
    """Every prompt with its turns; an empty list where there are none."""
    return prompts.join(collect_turns(history), "sample_id", "left").withColumn(
        "turns", F.coalesce("turns", F.array().cast(TURN))
    )


def result_rows(
    samples: DataFrame,
    attempts: DataFrame,
    history: DataFrame,
    low: int = MIN_ANSWER,
    high: int = MAX_ANSWER,
) -> DataFrame:
    """One outcome per sample: turns, success, error text, time and last client."""
    spans = attempts.groupBy("sample_id").agg((F.max("ts") - F.min("ts")).alias("_span"))
    joined = samples.join(collect_turns(history), "sample_id", "left").join(
        spans, "sample_id", "left"
    )
    fine = F.forall("turns", lambda t: within_limits(t["response"], low, high))
    good = F.coalesce((F.size("turns") > 0) & fine, F.lit(False))
    return (
        joined.withColumn("success", good)
        .withColumn(
            "turns", F.when(F.col("success"), F.col("turns")).otherwise(F.array().cast(TURN))
        )
        .withColumn("error_message", F.when(~F.col("success"), F.lit(VALIDATION_ERROR)))
        .withColumn(
            "processing_time",
            F.when(F.col("success"), F.coalesce("_span", F.lit(0.0))).otherwise(F.lit(0.0)),
        )
        .withColumn(
            "api_client_used",
            F.when(
                F.col("success"),
                F.coalesce(F.element_at("turns", -1)["client"], F.lit(NO_CLIENT)),
            ).otherwise(F.lit("")),
        )
        .drop("_span")
    )
