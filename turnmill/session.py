"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def get_session(app: str = "turnmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package is tuned for; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would lose data with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = os.path.join(tempfile.gettempdir(), "turnmill-steps")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


_open = threading.local()


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders of all steps that this thread begins inside, for ``drop_steps``."""
    if not hasattr(_open, "lists"):
        _open.lists = []
    folders: list[str] = []
    _open.lists.append(folders)
    try:
        yield folders
    finally:
        _open.lists.remove(folders)


def step_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    folder = f"{shared_dir(spark)}/turnmill/{uuid.uuid4().hex}"
    for folders in getattr(_open, "lists", []):
        folders.append(folder)
    return f"{folder}/{name}"


def drop_steps(spark: SparkSession, folders: list[str], keep: DataFrame | None = None) -> list[str]:
    """Delete recorded steps, but those that ``keep`` reads; returns the folders that stay.

    For callers whose results are written: a result that is not can no longer be computed.
    """
    files = keep.inputFiles() if keep is not None and folders else []
    left = [x for x in folders if any(f"/{os.path.basename(x)}/" in file for file in files)]
    for folder in set(folders).difference(left):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return left


def save_step(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table and read it back.

    This cuts the lineage with storage that outlives executors, and the reread
    table has real size statistics for the next join's broadcast decision.
    """
    path = step_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_counted(df: DataFrame, name: str, *counts: Column) -> tuple[DataFrame, dict]:
    """``save_step`` with named aggregates of the rows, taken while they are written.

    They are taken by the tasks that write, above every shuffle, and a partition counts
    once however often its task runs.
    """
    seen = Observation()
    saved = save_step(df.observe(seen, *counts), name)
    return saved, dict(seen.get)
