"""The whole chain from samples and attempts to finished records."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.functions.responses import MAX_ANSWER, MIN_ANSWER
from turnmill.functions.samples import sft_text
from turnmill.operators.formats import training_records, with_original
from turnmill.operators.near_dup import THRESHOLD, drop_near_duplicates
from turnmill.operators.report import (
    executed_summary,
    kept_counts,
    metadata_row,
    split_counts,
)
from turnmill.operators.split import (
    SEED,
    TRAIN_RATIO,
    split_order,
    subsample_test,
    train_test_split,
)
from turnmill.operators.turns import (
    CLIENTS,
    MAX_RETRIES,
    MAX_ROUNDS,
    assemble_history,
    client_statistics,
    first_success,
    result_rows,
)
from turnmill.session import drop_steps, recorded, save_counted, save_step
from turnmill.sources.writers import save_summary, write_bundle


def build_results(
    samples: DataFrame,
    attempts: DataFrame,
    clients: list[str] | None = None,
    chosen: Column | None = None,
    max_retries: int = MAX_RETRIES,
    max_rounds: int = MAX_ROUNDS,
    low: int = MIN_ANSWER,
    high: int = MAX_ANSWER,
) -> DataFrame:
    """One result row per sample from the attempts a batch-inference job made."""
    won = first_success(attempts, clients, chosen, max_retries)
    history = assemble_history(won, max_rounds, low, high)
    return result_rows(samples, attempts, history, low, high)


def format_results(
    results: DataFrame,
    seed: int = SEED,
    shuffle: bool = True,
    filter_duplicates: bool = True,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Successful results as records; near duplicates removed within each split.

    Earlier means earlier in the order the split took the rows.
    """
    records = training_records(results)
    if not filter_duplicates:
        return records
    ready = records.withColumn("_text", sft_text(F.col("conversations"))).withColumn(
        "_order", split_order("sample_id", seed, shuffle)
    )
    ready = save_step(ready, "records")
    kept = drop_near_duplicates(ready, "_text", "_order", by="split", threshold=threshold)
    return kept.drop("_text", "_order")


def build_records(
    samples: DataFrame,
    attempts: DataFrame,
    train_ratio: float = TRAIN_RATIO,
    seed: int = SEED,
    shuffle: bool = True,
    filter_duplicates: bool = True,
    threshold: float = THRESHOLD,
    **options,
) -> DataFrame:
    """Split, cut the test side down, assemble, and build the finished records."""
    parts = train_test_split(samples, "sample_id", train_ratio, seed, shuffle)
    chosen = subsample_test(parts, "sample_id", seed, shuffle)
    results = build_results(chosen, attempts, **options)
    return format_results(results, seed, shuffle, filter_duplicates, threshold)


def run(
    samples: DataFrame,
    attempts: DataFrame,
    out: str,
    clients: list[str] | None = None,
    train_ratio: float = TRAIN_RATIO,
    seed: int = SEED,
    shuffle: bool = True,
    filter_duplicates: bool = True,
    threshold: float = THRESHOLD,
    mode: str = "errorifexists",
    **options,
) -> DataFrame:
    """The whole run: write the result bundle and the summary; returns the summary row.

    Records carry the sample as it was given (``original_data``), not its prompt or
    source. Counts are taken while tables are written; steps go when all is written.
    """
    started = time.time()
    spark = samples.sparkSession
    config = {
        "train_ratio": train_ratio,
        "seed": seed,
        "shuffle": shuffle,
        "filter_duplicates": filter_duplicates,
        "similarity_threshold": threshold,
        "clients": ",".join(clients or CLIENTS),
        **{k: v for k, v in options.items() if not isinstance(v, Column)},
    }
    with recorded() as steps:
        parts = train_test_split(with_original(samples), "sample_id", train_ratio, seed, shuffle)
        chosen = subsample_test(parts, "sample_id", seed, shuffle)
        results, counts = save_counted(
            build_results(chosen, attempts, clients, **options), "results", *split_counts()
        )
        records, kept = save_counted(
            format_results(results, seed, shuffle, filter_duplicates, threshold),
            "kept",
            *kept_counts(),
        )
        told = {name: str(value) for name, value in config.items()}
        metadata = metadata_row(spark, counts, told, time.time())
        paths = write_bundle(records, metadata, out, mode)
        # One row per configured client.
        use = client_statistics(attempts, clients).collect()
        summary = executed_summary(metadata, use, paths, kept, started, time.time())
        save_summary(summary, out, mode)
    drop_steps(spark, steps)
    return summary
