"""Corpus pipeline: every stage works on what its predecessor kept."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm import exact, jaccard, language, mixing, packing
from turnmill.llm.common import read
from turnmill.session import drop_steps, recorded, save_step

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Whole texts are read from files and go to Python in batches of so many rows, at most. A
#: batch is held in the JVM and in Python, in buffers that double as they grow, so this
#: bounds a task's memory.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1_000,
    "spark.sql.parquet.columnarReaderBatchSize": 256,
}


_left = threading.local()  # folders of steps that the last stage's result may still read


def clean(spark: SparkSession, keep: DataFrame | None = None) -> None:
    """Delete the steps of this thread's last stage, but those that ``keep`` reads.

    Call it when the result of ``run`` or of a stage is written.
    """
    _left.folders = drop_steps(spark, getattr(_left, "folders", []), keep)


def stage(work: Stage) -> Stage:
    """A stage that first deletes the steps of the one before, whose result is written.

    It also lowers the session's batches to ``BATCHES``, for its lazy result too.
    """

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clean(spark, keep=docs)
        for batch, rows in BATCHES.items():
            if not 0 < int(spark.conf.get(batch)) <= rows:
                spark.conf.set(batch, str(rows))
        with recorded() as made:
            result = work(spark, docs, sf_dir)
        _left.folders += made
        return result

    return run_stage


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without a letter, and texts
    that the parse finds too unlike every learned language.

    The model learns from all labelled rows; with none, it knows no language and
    every document with letters stays.
    """
    model = language.fit(docs, F.lit(True), reject=True)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    named = language.predict(docs, model, [F.struct("*").alias("row")])
    return named.filter(F.col("lang_pred") != language.UNKNOWN).select("row.*")


@stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts stays."""
    return exact.drop_exact(docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by five-word shingles at 0.8 stays."""
    return jaccard.drop_similar(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in mix order, repeated as often as the mix takes them."""
    return mixing.mix(docs)


@stage
def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences without padding, with their ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_tokens),
]

#: The language stage cannot be put in SQL; tests hold a run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next.

    The result reads steps in the shared folder; ``clean`` deletes them.
    """
    docs, results = read(spark, sf_dir, "documents"), []
    for name, work in STAGES[:-1]:
        done = work(spark, docs, sf_dir)
        with recorded() as made:
            docs = save_step(done, name.replace(" ", "_"))
        drop_steps(spark, results)
        results = made
    last = STAGES[-1][1](spark, docs, sf_dir)
    _left.folders += results
    return last
