"""Packing by power-of-two decomposition.

A document of n tokens is cut into as many full sequences as fit and one piece
per binary digit of the rest. A piece is a sequence of its own, in the bucket of
its length, so nothing is padded and no sequence crosses documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import text_of
from turnmill.llm.tokens import WORD_BPE, tokenizer
from turnmill.session import save_step

LONGEST = 2048
END = 1  # the id after every document

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("part", pa.int32()),
        ("place", pa.int64()),
    ]
)
PIECE_DDL = "doc_id BIGINT, start BIGINT, length BIGINT, ids BINARY, doc_tokens BIGINT, part INT, place BIGINT"
PIECES_PER_BATCH = 20_000


def lengths(n: int, longest: int = LONGEST) -> Iterator[int]:
    """Lengths of the pieces of n tokens, longest first."""
    for _ in range(n // longest):
        yield longest
    rest, piece = n % longest, longest // 2
    while rest:
        if rest >= piece:
            yield piece
            rest -= piece
        piece //= 2


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str = WORD_BPE,
    longest: int = LONGEST,
    end: int = END,
) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit, ``longest`` is a power of two. A
    null or empty text is the end id alone. Rows that repeat are packed again.
    Sequences are numbered without gaps, bucket by bucket from the longest, by
    the input partition of their document; so the numbers depend on how the input
    is split into partitions, the pieces do not.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, places = TaskContext.get().partitionId(), {}
        tokens = tokenizer(path)
        last = tokens._pack([end])
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), PIECE)], schema=PIECE
            )

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokens.ids(value.as_py()) + last
                total, start = len(ids) // 4, 0
                for n in lengths(total, longest):
                    place = places.get(n, 0)
                    places[n] = place + 1
                    rows.append((doc, start, n, ids[4 * start : 4 * (start + n)], total, part, place))
                    start += n
                if len(rows) >= PIECES_PER_BATCH:
                    yield flush()
                    rows.clear()
            if rows:
                yield flush()
                rows.clear()

    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    pieces = save_step(narrow.mapInArrow(cut, PIECE_DDL), "pieces")
    # One row per length and input partition; the windows never see a piece.
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    inside = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    whole = counts.groupBy(F.col("length").alias("l")).agg(F.sum("n").alias("all"))
    base = whole.withColumn("base", F.sum("all").over(Window.orderBy(F.desc("l"))) - F.col("all"))
    starts = (
        counts.withColumn("inside", inside)
        .join(base, F.col("length") == F.col("l"))
        .select(F.col("length").alias("l"), F.col("part").alias("p"), (F.col("base") + F.col("inside")).alias("first"))
    )
    # Written, its size is known: Spark sends it to all tasks if it is small.
    starts = save_step(starts, "sequence_starts")
    return pieces.join(starts, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p"))).select(
        "doc_id",
        "start",
        "length",
        "ids",
        "doc_tokens",
        (F.col("first") + F.col("place")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
