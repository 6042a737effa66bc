"""Conversations from attempts that keep arriving.

A stateful operator holds, per sample, the winning attempt of every round and gives out all
rounds of a sample whenever one of its attempts arrives. The batch operators then assemble
the conversation from those rounds, so a stream decides as a batch does.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from turnmill.operators.turns import (
    MAX_RETRIES,
    MAX_ROUNDS,
    assemble_history,
    attempt_place,
    usable_attempt,
)
from turnmill.session import drop_steps, recorded, save_step
from turnmill.streaming.resume import ledger_parts

ROUND = "prompt STRING, response STRING, client STRING, ts DOUBLE, ok BOOLEAN"
#: What a sample's state holds of each of its rounds, at most ``max_rounds``.
WON = f"place INT, attempt_no INT, {ROUND}"
OUTPUT = f"sample_id BIGINT, round INT, {ROUND}, closed BOOLEAN"
NO_PLACE = 2**31 - 1
#: Seconds added to event times: a watermark begins at 1970, and what is not later counts as late.
SHIFT = 86_400

#: The state store that the operator needs, and its setting.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Rounds(StatefulProcessor):
    """Keeps the best attempt of every round until a sample has been idle long enough."""

    def __init__(self, idle_seconds: float) -> None:
        self.idle_ms = int(idle_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.won = handle.getMapState("won", "round INT", WON)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, last = self._held(), None
        best = dict(held)
        for frame in rows:
            for row in frame.itertuples(index=False):
                number = int(row.round)
                seen = best.get(number)
                best[number] = row_of(row) if seen is None else better(seen, row_of(row))
                last = row.ts if last is None or row.ts > last else last
        for number, value in best.items():
            if held.get(number) != value:
                self.won.updateValue((number,), value)
        due = int((last + SHIFT) * 1000) + self.idle_ms
        # A sample has one timer, after its latest attempt; one without state has none.
        timers = list(self.handle.listTimers()) if held else []
        for at in timers:
            if at < due:
                self.handle.deleteTimer(at)
        if not timers or max(timers) < due:
            self.handle.registerTimer(due)
        yield frame_of(key[0], best, closed=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best = self._held()
        self.won.clear()
        yield frame_of(key[0], best, closed=True)

    def close(self) -> None:
        pass

    def _held(self) -> dict[int, tuple]:
        return {number[0]: tuple(value) for number, value in self.won.iterator()}


def row_of(row) -> tuple:
    """An attempt as state: place, number, prompt, response, client, time, whether it succeeded."""

    def text(value):
        return None if pd.isna(value) else value

    if row.place == NO_PLACE:
        return (NO_PLACE, NO_PLACE, text(row.prompt), None, None, None, False)
    return (
        int(row.place),
        int(row.attempt_no),
        text(row.prompt),
        text(row.response),
        text(row.client),
        float(row.ts),
        True,
    )


def better(a: tuple, b: tuple) -> tuple:
    """The attempt that goes first, with the larger of both prompts, as in the batch operator.

    Ties go to the smaller response and time; NULL comes first.
    """

    def order(x):
        return x[0], x[1], x[3] is not None, x[3] or "", x[5] or 0.0

    first = min(a, b, key=order)
    prompts = [x[2] for x in (a, b) if x[2] is not None]
    return (*first[:2], max(prompts, default=None, key=lambda p: p.encode()), *first[3:])


def frame_of(key, best: dict[int, tuple], closed: bool) -> pd.DataFrame:
    """All rounds of a sample as output rows."""
    numbers = sorted(best)
    columns = list(zip(*[best[n] for n in numbers], strict=True)) or [()] * 7
    return pd.DataFrame(
        {
            "sample_id": pd.Series([key] * len(numbers), dtype="int64"),
            "round": pd.Series(numbers, dtype="int32"),
            "prompt": pd.Series(columns[2], dtype=object),
            "response": pd.Series(columns[3], dtype=object),
            "client": pd.Series(columns[4], dtype=object),
            "ts": pd.Series([float("nan") if t is None else t for t in columns[5]], dtype="float64"),
            "ok": pd.Series(columns[6], dtype=bool),
            "closed": pd.Series([closed] * len(numbers), dtype=bool),
        }
    )


def arriving_rounds(
    attempts: DataFrame,
    late_seconds: float,
    idle_seconds: float,
    clients: list[str] | None = None,
    max_retries: int = MAX_RETRIES,
    max_rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """All decided rounds of every sample that got an attempt, on a stream of attempts.

    ``ts`` is the event time in seconds since 1970. A sample closes when the watermark, which is
    ``late_seconds`` behind the latest attempt, has passed its last attempt by
    ``idle_seconds``: its rounds come out once more, as closed, and its state goes.
    Attempts behind the watermark are passed over, and so are those without sample, round
    or time. The state of an open sample is its rounds, at most ``max_rounds``.
    """
    named = attempts.filter(
        F.col("sample_id").isNotNull() & F.col("ts").isNotNull() & F.col("round").between(1, max_rounds)
    )
    place = F.when(usable_attempt(clients, max_retries), attempt_place(clients)).otherwise(NO_PLACE)
    return (
        named.select(
            F.col("sample_id").cast("bigint").alias("sample_id"),
            F.col("round").cast("int").alias("round"),
            place.cast("int").alias("place"),
            F.col("attempt_no").cast("int").alias("attempt_no"),
            "prompt",
            "response",
            "client",
            F.col("ts").cast("double").alias("ts"),
            F.timestamp_micros(((F.col("ts") + SHIFT) * 1_000_000).cast("bigint")).alias("at"),
        )
        .withWatermark("at", f"{int(late_seconds * 1000)} milliseconds")
        .groupBy("sample_id")
        .transformWithStateInPandas(
            Rounds(idle_seconds), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime"
        )
    )


def run_new_attempts(
    attempts: DataFrame, out: str, checkpoint: str, late_seconds: float, idle_seconds: float
) -> None:
    """Assemble the conversations of all samples with attempts that are new, and stop.

    Each micro-batch owns the folder ``p<batch>`` and overwrites it when repeated. It holds
    a row per sample: its turns so far, and whether it has closed.
    """
    spark = attempts.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        with recorded() as steps:
            # Written once: a second use of the batch would run its state again.
            rounds = save_step(batch, "rounds")
            turn = F.struct("round", "prompt", "response", "client", "ts")
            turns = assemble_history(rounds).groupBy("sample_id").agg(
                F.array_sort(F.collect_list(turn)).alias("turns")
            )
            state = rounds.groupBy("sample_id").agg(F.bool_or("closed").alias("closed"))
            state.join(turns, "sample_id", "left").write.mode("overwrite").parquet(f"{out}/p{batch_id:08d}")
        drop_steps(spark, steps)

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:
        query = (
            arriving_rounds(attempts, late_seconds, idle_seconds)
            .writeStream.outputMode("update")
            .foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(PROVIDER, before)
    query.awaitTermination()


def latest_conversations(spark: SparkSession, out: str) -> DataFrame:
    """Every sample's last state: its turns (NULL if none), and whether it has closed.

    A closed sample stays as it closed, whatever arrives for it later. The batch that
    counts is found on keys alone; the rows then join it.
    """
    parts = ledger_parts(spark, out)
    if not parts:
        raise ValueError(f"no results in {out}")
    named = F.regexp_extract("_metadata.file_path", r"/p(\d+)/[^/]*$", 1).cast("bigint")
    rows = spark.read.parquet(*[f"{out}/{n}" for n in parts]).withColumn("batch", named)
    closed = F.min(F.when(F.col("closed"), F.col("batch")))
    last = rows.groupBy("sample_id").agg(F.coalesce(closed, F.max("batch")).alias("batch"))
    return rows.join(last, ["sample_id", "batch"], "left_semi").drop("batch")
