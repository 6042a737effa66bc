"""Runs that continue where an earlier one stopped.

A ledger names the finished keys, a part per run. Pending rows are those not in it;
every run's results are a folder of their own, and their keys are entered after it. For files that keep
arriving, the same step runs as a stream that processes what is new and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.sources.files import checked_lines


def pending(samples: DataFrame, ledger: DataFrame, key: str = "sample_id") -> DataFrame:
    """Samples whose key is not in the ledger yet."""
    return samples.join(ledger.select(key), key, "left_anti")


def _folder(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system and path of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _folder(spark, path)
    if not fs.exists(at):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(at))


def _whole(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote this folder was committed."""
    fs, at = _folder(spark, f"{path}/_SUCCESS")
    return fs.exists(at)


def ledger_parts(spark: SparkSession, path: str) -> list[str]:
    """Committed parts of a ledger, oldest first, without those that a compaction replaced.

    A part ``p00000007`` holds the keys of run 7; ``c00000007`` those of all runs to 7.
    One listing is a snapshot: parts never change, and one still being written has no
    commit mark.
    """
    parts = [n for n in _names(spark, path) if n[:1] in ("p", "c") and n[1:].isdigit()]
    done = [n for n in parts if _whole(spark, f"{path}/{n}")]
    base = max((n for n in done if n.startswith("c")), key=lambda n: int(n[1:]), default=None)
    since = int(base[1:]) if base else -1
    later = [n for n in done if n.startswith("p") and int(n[1:]) > since]
    return ([base] if base else []) + sorted(later, key=lambda n: int(n[1:]))


def read_ledger(spark: SparkSession, path: str, key: str = "sample_id") -> DataFrame:
    """Finished keys under ``path``; an empty ledger when nothing was written so far."""
    schema = f"{key} BIGINT, success BOOLEAN"
    parts = ledger_parts(spark, path)
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in parts])


def committed_runs(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the runs whose results are committed."""
    numbers = [int(n[4:]) for n in _names(spark, out) if n.startswith("run=") and n[4:].isdigit()]
    return sorted(n for n in numbers if _whole(spark, f"{out}/run={n}"))


def claim(spark: SparkSession, out: str) -> int:
    """The next run's number, claimed by creating a file that must not exist yet."""
    taken = [int(n) for n in _names(spark, f"{out}/_claims") if n.isdigit()]
    number = max(taken, default=-1) + 1
    while True:
        fs, at = _folder(spark, f"{out}/_claims/{number:08d}")
        try:
            fs.create(at, False).close()
            return number
        except Py4JJavaError:
            if not fs.exists(at):
                raise
            number += 1


def _enter(spark: SparkSession, out: str, ledger: str, run: int, key: str) -> None:
    """Write the ledger part of one run from the run's own files."""
    written = spark.read.parquet(f"{out}/run={run}").select(key, "success").dropDuplicates([key])
    written.write.mode("overwrite").parquet(f"{ledger}/p{run:08d}")


def record(results: DataFrame, out: str, ledger: str, key: str = "sample_id") -> None:
    """Write results as a run of their own, then the keys of what was written.

    ``results`` runs once, and only its own files are read back. A run that dies in
    between leaves committed results without a ledger part; the next call, or
    :func:`repair`, enters it from its files. Results that were not committed are in no
    snapshot, and their samples stay pending.
    """
    spark = results.sparkSession
    run = claim(spark, out)
    results.write.mode("overwrite").parquet(f"{out}/run={run}")
    repair(spark, out, ledger, key)


def repair(spark: SparkSession, out: str, ledger: str, key: str = "sample_id") -> list[int]:
    """Enter the committed runs that the ledger does not know; returns their numbers."""
    parts = ledger_parts(spark, ledger)
    since = next((int(n[1:]) for n in parts if n.startswith("c")), -1)
    known = {int(n[1:]) for n in parts}
    missing = [n for n in committed_runs(spark, out) if n > since and n not in known]
    for run in missing:
        _enter(spark, out, ledger, run, key)
    return missing


def compact(spark: SparkSession, out: str, ledger: str, key: str = "sample_id") -> str | None:
    """Join the parts of a ledger into one, each key once; returns its name.

    Replaced parts stay for readers of older snapshots. Call it while no run is being
    recorded: a run with a lower number that commits later would not be entered.
    """
    repair(spark, out, ledger, key)
    parts = ledger_parts(spark, ledger)
    if len(parts) < 2:
        return None
    name = f"c{int(parts[-1][1:]):08d}"
    keys = read_ledger(spark, ledger, key).groupBy(key).agg(F.bool_or("success").alias("success"))
    keys.write.mode("overwrite").parquet(f"{ledger}/{name}")
    return name


def finished(spark: SparkSession, out: str, key: str = "sample_id") -> DataFrame:
    """All results of committed runs, one row per key: the one of the last run.

    The last run of a key is found on keys and run numbers alone; the rows then join it.
    """
    runs = committed_runs(spark, out)
    if not runs:
        raise ValueError(f"no results in {out}")
    rows = spark.read.option("basePath", out).parquet(*[f"{out}/run={n}" for n in runs])
    last = rows.groupBy(key).agg(F.max("run").alias("run"))
    return rows.join(last, [key, "run"], "left_semi").dropDuplicates([key]).drop("run")


def run_new_files(
    spark: SparkSession,
    source: str,
    work: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
) -> None:
    """Process JSON Lines files that arrived in ``source`` since the last call.

    Each micro-batch owns one output folder and overwrites it when repeated, so
    a restart neither loses nor doubles rows. Lines are checked as in ``read_jsonl``.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    (
        checked_lines(spark.readStream.text(source))
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
