"""Tokens per document from flat token files without an index.

A file is nothing but token ids; an end-of-document id follows every document.
Blocks of a file are scanned independently for that id; what a block knows of
the documents at its ends is stitched by running sums over the blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnmill.llm.common import file_system, new_folder, tasks, text_of
from turnmill.llm.tokens import WORD_BPE, tokenizer
from turnmill.session import save_step

END = 49407  # an id that no text has, as its string is read as ordinary text
DTYPE = "<u2"  # the vocabulary fits 16 bits
BLOCK = 4 << 20

WRITTEN = pa.schema(
    [("file", pa.string()), ("ordinal", pa.int64()), ("rid", pa.int64()), ("bytes", pa.int64())]
)
WRITTEN_DDL = "file STRING, ordinal BIGINT, rid BIGINT, bytes BIGINT"


def write_token_files(
    docs: DataFrame, folder: str, rid: str, text: str = "text", path: str = WORD_BPE, end: int = END, dtype: str = DTYPE
) -> DataFrame:
    """Write one flat file per input partition; returns which document is where.

    One row per document (file, ordinal, rid), and one per file with its size
    (ordinal and rid null). A file's name is new for every attempt of a task, so
    a lost or repeated attempt leaves a file that no row names.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer(path, dtype, True)
        last = tokens._pack([end])
        system, root = file_system(folder)
        file = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        out, ordinal, size = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or system.open_output_stream(f"{root}/{file}")
            for value in batch.column(1):
                ids = tokens.ids(value.as_py())
                size += out.write(ids) + out.write(last)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([file] * n),
                    pa.array(np.arange(ordinal, ordinal + n)),
                    batch.column(0).cast(pa.int64()),
                    pa.nulls(n, pa.int64()),
                ],
                schema=WRITTEN,
            )
            ordinal += n
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([size])], schema=WRITTEN
            )

    rows = docs.select(F.col(rid).alias("rid"), text_of(text).alias("text"))
    return save_step(rows.mapInArrow(write, WRITTEN_DDL), "token_files")


def count_tokens(
    spark: SparkSession, files: DataFrame, folder: str, end: int = END, dtype: str = DTYPE, block: int = BLOCK
) -> DataFrame:
    """Tokens of every document of flat files: file, ordinal, n_tokens (without the end id).

    ``files`` has file and bytes. A file must end with the end id; ids after its
    last one count as a document too. Memory is one block, however long a document.
    """
    width = np.dtype(dtype).itemsize
    block -= block % width

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{root}/{row['file']}") as f:
                    ids = np.frombuffer(f.read_at(min(block, row["bytes"] - row["at"]), row["at"]), dtype)
                ends = np.flatnonzero(ids == end)
                # Lengths of documents that end here; the first may have begun in an earlier block.
                counts = np.diff(ends, prepend=-1) - 1
                open_ids = len(ids) - (ends[-1] + 1 if len(ends) else 0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": [row["file"]],
                        "at": [row["at"]],
                        "counts": pa.array([counts], pa.list_(pa.int64())),
                        "open": [int(open_ids)],
                    }
                )

    blocks = files.withColumn(
        "at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0).cast("bigint")), F.lit(block).cast("bigint")))
    ).filter("bytes > 0")
    blocks = blocks.select("file", "bytes", "at").repartition(tasks(spark), "file", "at")
    # One row per block; the arrays hold the documents that end in it.
    scanned = save_step(
        blocks.mapInArrow(scan, "file STRING, at BIGINT, counts ARRAY<BIGINT>, open BIGINT"), "token_blocks"
    )
    summary = scanned.select("file", "at", F.size("counts").alias("n"), "open")
    # Stitching: a prefix scan over the blocks of a file, by numbers only.
    order = Window.partitionBy("file").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    first = F.coalesce(F.sum("n").over(before), zero)
    # Blocks since the last end form a run; their open ids belong to the next end.
    runs = summary.withColumn("first", first).withColumn("final", F.lead("at").over(order).isNull())
    in_run = Window.partitionBy("file", "first").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.withColumn("held", F.coalesce(F.sum("open").over(in_run), zero))
    # A block with an end opens the run that its successors continue.
    opener = runs.filter("n > 0").select(
        F.col("file").alias("f"), (F.col("first") + F.col("n")).alias("o"), F.col("open").alias("opened")
    )
    stitched = carried.join(opener, (F.col("file") == F.col("f")) & (F.col("first") == F.col("o")), "left").select(
        F.col("file").alias("sf"),
        F.col("at").alias("sa"),
        "first",
        "final",
        (F.col("held") + F.coalesce("opened", zero)).alias("carry"),
    )
    joined = scanned.join(stitched, (F.col("file") == F.col("sf")) & (F.col("at") == F.col("sa")))
    counted = joined.select(
        "file", "first", "carry", F.posexplode("counts").alias("i", "c")
    ).select(
        "file",
        (F.col("first") + F.col("i")).alias("ordinal"),
        (F.col("c") + F.when(F.col("i") == 0, F.col("carry")).otherwise(zero)).alias("n_tokens"),
    )
    n = F.size("counts")
    tail = joined.filter("final").select(
        "file",
        (F.col("first") + n).cast("bigint").alias("ordinal"),
        (F.col("open") + F.when(n == 0, F.col("carry")).otherwise(zero)).alias("n_tokens"),
    )
    return counted.unionAll(tail.filter("n_tokens > 0"))


def document_token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = WORD_BPE) -> DataFrame:
    """Write the documents as flat token files, scan the files, and give every document its count."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    written = write_token_files(docs, folder, key, text, path)
    counts = count_tokens(spark, written.filter("bytes IS NOT NULL"), folder)
    places = written.filter("bytes IS NULL").select(
        F.col("file").alias("f"), F.col("ordinal").alias("o"), F.col("rid").alias("doc_id")
    )
    return counts.join(places, (F.col("file") == F.col("f")) & (F.col("ordinal") == F.col("o"))).select(
        "doc_id", "n_tokens", "file", "ordinal"
    )
