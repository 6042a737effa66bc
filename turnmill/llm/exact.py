"""Exact duplicates by an extendible-hash index on shared files.

Every distinct text goes once per batch to the task that owns its range of
keys. A directory of hash prefixes, doubled until no bucket is overfull, says
which task that is. The owner takes its buckets in key order, chains texts whose
keys collide, compares their bytes, and writes the buckets to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm.common import SPACE, tasks, text_of
from turnmill.session import save_step

MAX_DEPTH = 16  # at most 65,536 directory cells, whatever the data
BUCKETS_PER_TASK = 4

ENTRY = pa.schema(
    [
        ("bucket", pa.int32()),
        ("owner", pa.int32()),
        ("key", pa.int64()),
        ("norm", pa.string()),
        ("best_chars", pa.int64()),
        ("best_id", pa.int64()),
        ("copies", pa.int64()),
    ]
)
ENTRY_DDL = "bucket INT, owner INT, key BIGINT, norm STRING, best_chars BIGINT, best_id BIGINT, copies BIGINT"
INDEX = pa.schema([("chain", pa.int32()), *[f for f in ENTRY if f.name != "owner"]])
INDEX_DDL = "chain INT, bucket INT, key BIGINT, norm STRING, best_chars BIGINT, best_id BIGINT, copies BIGINT"


def directory(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """Bucket and local depth of every cell, from rows per ``MAX_DEPTH``-bit prefix.

    It starts as one cell. An overfull bucket splits by its next bit; where it
    has used all bits of the directory, the directory doubles first. A bucket
    that is overfull at full depth stays so: its rows are chained.
    """
    size = 1 << MAX_DEPTH
    total = [0]
    for prefix in range(size):
        total.append(total[-1] + counts.get(prefix, 0))
    depth, buckets = 0, {0: (0, size)}  # local depth and range of prefixes, by first prefix
    pending = [0]
    while pending:
        first = pending.pop()
        local, width = buckets[first]
        if total[first + width] - total[first] <= capacity or local == MAX_DEPTH:
            continue
        depth = max(depth, local + 1)
        half = width // 2
        buckets[first] = (local + 1, half)
        buckets[first + half] = (local + 1, half)
        pending += [first, first + half]
    cells, cell = [], size >> depth
    for number, first in enumerate(sorted(buckets)):
        local, width = buckets[first]
        cells += [(number, local)] * (width // cell)
    return cells


def owners(cells: list[tuple[int, int]], counts: dict[int, int], tasks_no: int) -> list[int]:
    """The owner of every bucket: ranges of buckets with about equal rows."""
    cell = (1 << MAX_DEPTH) // len(cells)
    rows: dict[int, int] = {}
    for i, (bucket, _) in enumerate(cells):
        rows[bucket] = rows.get(bucket, 0) + sum(
            counts.get(p, 0) for p in range(i * cell, (i + 1) * cell)
        )
    share = max(1, -(-sum(rows.values()) // tasks_no))
    owner, seen = [], 0
    for bucket in range(len(rows)):
        owner.append(min(tasks_no - 1, (seen + rows[bucket] // 2) // share))
        seen += rows[bucket]
    return owner


def _better(chars: int, key: int | None, than_chars: int, than: int | None) -> bool:
    """More code points first, then the smaller key, null last."""
    if chars != than_chars:
        return chars > than_chars
    return key is not None and (than is None or key < than)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a batch as one entry, so a hot text is sent once per batch."""
    for batch in batches:
        groups: dict[str, list] = {}
        for row in batch.to_pylist():
            held = groups.get(row["norm"])
            if held is None:
                groups[row["norm"]] = [
                    row["bucket"], row["owner"], row["key"], row["norm"], row["chars"], row["id"], 1
                ]
                continue
            held[6] += 1
            if _better(row["chars"], row["id"], held[4], held[5]):
                held[4:6] = row["chars"], row["id"]
        if groups:
            columns = zip(*groups.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, ENTRY)], schema=ENTRY
            )


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in key order to one row per distinct text; equal keys form a chain."""
    key, chain = None, []

    def flush(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), INDEX)], schema=INDEX
        )

    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if key != (row["bucket"], row["key"]):
                done += chain
                key, chain = (row["bucket"], row["key"]), []
            for held in chain:
                if held[3] == row["norm"]:  # the bytes decide, not the key
                    held[6] += row["copies"]
                    if _better(row["best_chars"], row["best_id"], held[4], held[5]):
                        held[4:6] = row["best_chars"], row["best_id"]
                    break
            else:
                chain.append(
                    [len(chain), row["bucket"], row["key"], row["norm"], row["best_chars"], row["best_id"], row["copies"]]
                )
        if done:
            yield flush(done)
    if chain:
        yield flush(chain)


def build_index(docs: DataFrame, narrow: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index, written to the shared folder: one row per distinct normalised text."""
    spark: SparkSession = docs.sparkSession
    prefix = F.shiftrightunsigned("key", 64 - MAX_DEPTH).cast("int")
    # Bounded whatever the data: at most 65,536 counts.
    counts = {p: n for p, n in narrow.groupBy(prefix.alias("p")).count().collect()}
    n = tasks(spark)
    capacity = max(1, sum(counts.values()) // (BUCKETS_PER_TASK * n))
    cells = directory(counts, capacity)
    owner = owners(cells, counts, n)
    cell_bits = (len(cells) - 1).bit_length()
    table = spark.createDataFrame(
        [(i, b, owner[b]) for i, (b, _) in enumerate(cells)], "cell INT, bucket INT, owner INT"
    )
    cell = F.shiftrightunsigned("key", 64 - cell_bits).cast("int") if cell_bits else F.lit(0)
    rows = (
        docs.select(
            F.col(key).cast("bigint").alias("id"),
            F.length(text_of(text)).cast("bigint").alias("chars"),
            F.translate(text_of(text), SPACE, "").alias("norm"),
        )
        .withColumn("key", F.xxhash64("norm"))
        .withColumn("cell", cell)
        .join(F.broadcast(table), "cell")
        .select("bucket", "owner", "key", "norm", "chars", "id")
    )
    entries = rows.mapInArrow(_collapse, ENTRY_DDL)
    owned = entries.repartitionById(n, F.col("owner")).sortWithinPartitions("bucket", "key")
    return save_step(owned.mapInArrow(_chain, INDEX_DDL), "exact_index")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, keep_id, group_size, kept and the digest of the normalised text.

    Texts are equal when identical after deleting every ASCII white-space
    character; null counts as empty. The row with the most code points stays,
    then the one with the smallest key (null last). Rows that also share key and
    length are indistinguishable here and marked alike.
    """
    norm = F.translate(text_of(text), SPACE, "")
    narrow = save_step(
        docs.select(
            F.col(key).alias("doc_id"),
            F.length(text_of(text)).cast("bigint").alias("chars"),
            norm.alias("norm"),
        ).select(
            "doc_id", "chars", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("text_sha256")
        ),
        "exact_rows",
    )
    index = build_index(docs, narrow, key, text)
    groups = index.select(
        F.sha2("norm", 256).alias("text_sha256"),
        F.col("best_id").alias("keep_id"),
        "best_chars",
        F.col("copies").alias("group_size"),
    )
    return narrow.join(groups, "text_sha256").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("best_chars"))).alias("kept"),
        "text_sha256",
    )


def drop_exact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole; of indistinguishable rows one stays.

    What goes is listed by key alone, so whole rows meet a narrow list. Only the rows of
    keys that several rows share are told apart by text, and grouped to keep one of them.
    """
    marked = save_step(exact_groups(docs, key, text).select("doc_id", "text_sha256", "kept"), "exact_marks")
    by_key = marked.groupBy(F.col("doc_id").alias("k2")).agg(F.count_if("kept").alias("kept"), F.count("*").alias("n"))
    listed = save_step(by_key.filter("n > 1 OR kept = 0"), "exact_decisions")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(key).alias("k"),
        F.length(text_of(text)).alias("chars"),
        F.sha2(F.translate(text_of(text), SPACE, ""), 256).alias("h"),
    )
    same_key = F.col("k").eqNullSafe(F.col("k2"))
    alone = rows.join(listed.select("k2"), same_key, "left_anti").select("row.*")
    several = listed.filter("n > 1 AND kept > 0").select("k2")
    if several.isEmpty():
        return alone
    kept = marked.filter("kept").select(F.col("doc_id").alias("k2"), F.col("text_sha256").alias("h2")).distinct()
    # Of rows that share key and text, the longest as it was written.
    some = rows.join(several, same_key, "left_semi").join(kept, same_key & (F.col("h") == F.col("h2")), "left_semi")
    one = some.groupBy("k", "h").agg(F.max_by("row", "chars").alias("row"))
    return alone.unionAll(one.select("row.*"))
