"""Counts over splits and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def split_counts() -> list[Column]:
    """Total and successful rows of each split, as aggregates."""
    train, test = F.col("split") == "train", F.col("split") == "test"
    return [
        F.count_if(train).alias("total_train_samples"),
        F.count_if(train & F.col("success")).alias("successful_train_samples"),
        F.count_if(test).alias("total_test_samples"),
        F.count_if(test & F.col("success")).alias("successful_test_samples"),
    ]


def kept_counts() -> list[Column]:
    """Rows of each split that are left, as aggregates."""
    return [
        F.count_if(F.col("split") == "train").alias("kept_train_samples"),
        F.count_if(F.col("split") == "test").alias("kept_test_samples"),
    ]


def generation_metadata(results: DataFrame) -> DataFrame:
    """One row: total and successful rows of each split, before near-duplicate removal."""
    return results.agg(*split_counts())


def metadata_row(
    spark: SparkSession, counts: dict[str, int], config: dict[str, str], timestamp: float
) -> DataFrame:
    """The same row from counts already taken, with the run's options and time."""
    schema = ", ".join(f"{name} BIGINT" for name in counts)
    values = (*counts.values(), config, timestamp)
    return spark.createDataFrame(
        [values], f"{schema}, generation_config MAP<STRING, STRING>, timestamp DOUBLE"
    )


def executed_summary(
    metadata: DataFrame,
    clients: list[Row],
    outputs: dict[str, str],
    kept: dict[str, int],
    started: float,
    ended: float,
) -> DataFrame:
    """One row: times, counts, rows kept after near-duplicate removal, outputs, client use."""
    use = F.array(
        *[
            F.struct(
                F.lit(c.client).alias("client"),
                F.lit(c.request_count).cast("bigint").alias("request_count"),
                F.lit(c.last_request_time).cast("double").alias("last_request_time"),
                F.lit(c.available).alias("available"),
            )
            for c in sorted(clients, key=lambda c: c.client)
        ]
    )
    times = {"start_time": started, "end_time": ended, "total_execution_time": ended - started}
    return metadata.select(
        "*",
        *[F.lit(n).cast("bigint").alias(name) for name, n in kept.items()],
        *[F.lit(t).cast("double").alias(name) for name, t in times.items()],
        F.create_map(*[F.lit(x) for kv in sorted(outputs.items()) for x in kv]).alias("output_files"),
        use.alias("clients"),
    )


def progress_statistics(results: DataFrame) -> DataFrame:
    """One row: rows processed so far, and how many failed or succeeded."""
    return results.agg(
        F.count("*").alias("processed_samples"),
        F.count_if(~F.col("success")).alias("failed_samples"),
        F.count("*").alias("total_results"),
        F.count_if(F.col("success")).alias("successful_results"),
    )


def run_summary(
    results: DataFrame,
    clients: DataFrame,
    outputs: dict[str, str],
    kept: DataFrame | None = None,
) -> DataFrame:
    """One row: counts, rows kept after near-duplicate removal, outputs, client use."""
    paths = F.create_map(*[F.lit(x) for kv in sorted(outputs.items()) for x in kv])
    # One entry per configured client.
    use = clients.agg(F.array_sort(F.collect_list(F.struct(*clients.columns))).alias("clients"))
    row = generation_metadata(results).withColumn("output_files", paths).withColumn("_k", F.lit(1))
    row = row.join(use.withColumn("_k", F.lit(1)), "_k")
    if kept is not None:
        left = kept.agg(*kept_counts())
        row = row.join(left.withColumn("_k", F.lit(1)), "_k")
    return row.drop("_k")
