"""Repeated runs of lines by winnowing.

Of every ``run`` neighbouring lines the least line hash is a fingerprint, so any
repeated run of that many lines has a fingerprint in common with its first place.
Only lines around fingerprints that occur again are looked at further: the runs
that cover such a place, extended line by line both ways, are compared with the
first place of the same run, and later places are deleted.

Shorter runs count if they have ``words`` words or are all of a document. They are
compared as they are; the lines of other documents, where a whole document may
occur first, go through a sieve of such documents, so that few are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import SPACE, WORD, numbered, text_of
from turnmill.session import save_step

RUN = 3
WORDS = 50  # a run of fewer lines counts from so many words
SLOTS = 1 << 24  # bits of the sieve
LINES = pa.schema(
    [
        ("rid", pa.int64()),
        ("doc_id", pa.int64()),
        ("places", pa.list_(pa.int32())),
        ("hashes", pa.list_(pa.int64())),
        ("minima", pa.list_(pa.int32())),
        ("short", pa.list_(pa.int32())),
        ("whole", pa.int64()),
    ]
)
LINES_DDL = (
    "rid BIGINT, doc_id BIGINT, places ARRAY<INT>, hashes ARRAY<BIGINT>, minima ARRAY<INT>, "
    "short ARRAY<INT>, whole BIGINT"
)
RUNS = pa.schema(
    [
        ("rid", pa.int64()),
        ("doc_id", pa.int64()),
        ("start", pa.int32()),
        ("run", pa.int64()),
        ("covered", pa.list_(pa.int32())),
        ("may", pa.bool_()),
    ]
)
RUNS_DDL = "rid BIGINT, doc_id BIGINT, start INT, run BIGINT, covered ARRAY<INT>, may BOOLEAN"


def window_minima(hashes: np.ndarray, run: int) -> np.ndarray:
    """Places that are the last least hash of some window of ``run`` lines."""
    if len(hashes) < run:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, run)
    last_least = run - 1 - np.argmin(windows[:, ::-1], axis=1)
    return np.unique(last_least + np.arange(len(windows)))


def run_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """A key of every run of ``size`` lines, unsigned."""
    count = max(0, len(hashes) - size + 1)
    keys = np.full(count, size, np.uint64)
    for i in range(size):
        keys = (keys ^ hashes.view(np.uint64)[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys


def short_runs(counts: list[int], run: int, words: int) -> list[int]:
    """Runs of less than ``run`` lines that count, as start * run + lines."""
    total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    found = []
    for size in range(1, min(run, len(total))):
        counted = (total[size:] - total[:-size] >= words) | (size == len(counts))
        found += (np.flatnonzero(counted) * run + size).tolist()
    return found


def _lines(run: int, words: int | None):
    word = re.compile(WORD)

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rid, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                lines = [x.strip(SPACE) for x in text.split("\n")]
                places = [i for i, x in enumerate(lines) if x]
                hashes = np.array([xxhash.xxh3_64_intdigest(lines[i]) for i in places], np.uint64).view(np.int64)
                minima = window_minima(hashes, run).astype(np.int32)
                short, whole = [], None
                if words is not None:
                    short = short_runs([len(word.findall(lines[i])) for i in places], run, words)
                    if 0 < len(places) < run:
                        whole = int(run_keys(hashes, len(places)).view(np.int64)[0])
                rows.append((rid, doc, places, hashes, minima, short, whole))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), LINES)], schema=LINES
                )

    return fingerprints


def _around(run: int):
    """The runs of ``run`` lines that cover a hit: the match of one fingerprint, extended
    line by line both ways. Linear in a row's lines."""

    def table(parts: list[tuple]) -> pa.RecordBatch:
        rids, docs, starts, keys, covered = (np.concatenate(x) for x in zip(*parts))
        ends = np.arange(0, len(covered) + 1, run, dtype=np.int32)
        columns = [
            pa.array(rids),
            pa.array(docs[:, 0], mask=docs[:, 1] > 0),
            pa.array(starts, pa.int32()),
            pa.array(keys),
            pa.ListArray.from_arrays(ends, pa.array(covered, pa.int32())),
            pa.array(np.ones(len(rids), bool)),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=RUNS)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            lists = [batch.column(i) for i in (2, 3, 4)]
            for i, (rid, doc) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                places, hashes, hits = (x[i].values.to_numpy().astype(np.int64) for x in lists)
                change = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(change, np.maximum(hits - run + 1, 0), 1)
                np.add.at(change, hits + 1, -1)
                starts = np.flatnonzero(np.cumsum(change[: max(0, len(hashes) - run + 1)]))
                own = np.full((len(starts), 2), (doc or 0, doc is None), np.int64)
                covered = places[starts[:, None] + np.arange(run)].ravel()
                keys = run_keys(hashes, run)[starts].view(np.int64)
                parts.append((np.full(len(starts), rid, np.int64), own, starts, keys, covered))
                size += len(starts)
                if size >= 100_000:
                    yield table(parts)
                    parts, size = [], 0
            if parts:
                yield table(parts)

    return extend


def _sieve(lines: DataFrame) -> np.ndarray:
    """A bit per slot that the key of a whole document of few lines falls into."""
    slot = F.col("whole").bitwiseAND(SLOTS - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(63).cast("int"))
    cells = (
        lines.filter("whole IS NOT NULL")
        .groupBy(F.shiftright(slot, 6).alias("cell"))
        .agg(F.bit_or(bit).alias("bits"))
        .toArrow()
    )
    sieve = np.zeros(SLOTS // 64, np.int64)
    sieve[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return sieve.view(np.uint64)


def _short(lines: DataFrame, run: int) -> DataFrame:
    """Runs of less than ``run`` lines that may go, or where a whole document may occur first."""
    shared = lines.sparkSession.sparkContext.broadcast(_sieve(lines))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = shared.value
        for batch in batches:
            rows = []
            for rid, doc, *lists in zip(*(c.to_pylist() for c in batch.columns)):
                places, hashes, short = (np.array(x, np.int64) for x in lists)
                for size in range(1, min(run, len(places) + 1)):
                    keys = run_keys(hashes, size)
                    slots = keys & np.uint64(SLOTS - 1)
                    seen = (sieve[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)
                    may = np.zeros(len(keys), bool)
                    may[short[short % run == size] // run] = True
                    for i in np.flatnonzero(seen | may).tolist():
                        key = int(keys[i : i + 1].view(np.int64)[0])
                        rows.append((rid, doc, i, key, places[i : i + size], bool(may[i])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), RUNS)], schema=RUNS
                )

    return lines.select("rid", "doc_id", "places", "hashes", "short").mapInArrow(find, RUNS_DDL)


def repeated_lines(docs: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """Per row of ``docs`` (rid, doc_id, text) with repeated runs: rid, gone (line numbers).

    Lines are compared without white space at their ends; blank lines are passed
    over. A line goes if it lies in a run of ``run`` lines that occurs earlier: in
    a row with a smaller doc_id (null first), or the same and a smaller rid, or
    before it in the same row. A line also goes if it lies in a shorter run that
    occurs earlier and has ``words`` words or is all of its row; null: no shorter runs.
    """
    lines = save_step(
        docs.select("rid", "doc_id", text_of().alias("text")).mapInArrow(_lines(run, words), LINES_DDL), "lines"
    )
    marks = lines.select("rid", F.explode("minima").alias("at"), "hashes").select(
        "rid", "at", F.get("hashes", F.col("at")).alias("mark")
    )
    again = marks.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark")
    # At most as many places as a row has lines.
    hits = marks.join(again, "mark").groupBy("rid").agg(F.collect_set("at").alias("hits"))
    around = lines.join(hits, "rid").select("rid", "doc_id", "places", "hashes", "hits")
    runs = around.mapInArrow(_around(run), RUNS_DDL)
    if words is not None:
        runs = runs.unionByName(_short(lines, run))
    runs = save_step(runs, "line_runs")
    where = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "rid", "start")
    first = runs.groupBy("run").agg(F.min(where).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = runs.filter("may").join(first, "run").filter(
        (F.col("rid") != F.col("first.rid")) | (F.col("start") != F.col("first.start"))
    )
    return (
        later.select("rid", F.explode("covered").alias("line"))
        .groupBy("rid")
        .agg(F.sort_array(F.collect_set("line")).alias("gone"))
    )


def drop_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", run: int = RUN, words: int | None = WORDS
) -> DataFrame:
    """Per row: doc_id, n_lines, removed_lines, text (without them; null stays null)."""
    rows = numbered(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")), "line_texts")
    gone = repeated_lines(rows, run, words).withColumnRenamed("rid", "r")
    lines = F.split("text", "\n", -1)
    none = F.array().cast("array<int>")
    # A set difference of numbers, then the lines they stand for: linear in the lines.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.when(F.size("gone") == 0, F.col("lines")).otherwise(
        F.transform(left, lambda i: F.get("lines", i))
    )
    return (
        rows.join(gone, F.col("rid") == F.col("r"), "left")
        .select("doc_id", lines.alias("lines"), F.coalesce("gone", none).alias("gone"))
        .select(
            "doc_id",
            F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
            F.size("gone").cast("bigint").alias("removed_lines"),
            F.when(F.col("lines").isNotNull(), F.array_join(kept, "\n")).alias("text"),
        )
    )
