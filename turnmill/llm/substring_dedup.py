"""Repeated passages by content-defined chunks.

A gear rolling hash over a text's bytes decides where chunks end, so equal
passages are cut alike wherever they stand, but for the chunks at their ends.
Every chunk knows the first place of its digest. Chunks of a row that stand at one
distance from their first places in one other row are a match; it is extended byte by
byte both ways, and only bytes that were compared are removed, if they are enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import numbered, text_of
from turnmill.llm.shingles import mix64
from turnmill.session import save_step

CUT_BITS = 5  # a raw cut every 32 bytes
LEAST_GAP = 12
MOST = 2048
MIN_BYTES = 128  # about 20 words
SEED = 64  # bytes of whole chunks from which a match is looked at
REACH = 192  # bytes beyond its chunks that a match is extended at most

U = np.uint64
_rng = np.random.default_rng(977)
_GEAR = _rng.integers(0, 1 << 32, 256, dtype=np.uint32)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_STEP = U(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)

CHUNKS = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("digest", pa.int64())])
CHUNKS_DDL = "rid BIGINT, doc_id BIGINT, chunk BIGINT, digest BIGINT"
SIZE_BITS = 12  # a chunk's number is its start and its size
ROWS_OUT = 200_000


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte: each older byte shifted once more."""
    h = _GEAR[data]
    step = 1
    while step < 32:
        older = np.zeros_like(h)
        older[step:] = h[:-step]
        h = h + (older << np.uint32(step))
        step *= 2
    return h


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text's bytes, the last one its length.

    A cut follows a byte whose hash starts with zeros, unless another such byte
    is less than ``LEAST_GAP`` before it, and never splits a character. Both look
    at a few bytes only, so they do not depend on where the text begins. A chunk
    of more than ``MOST`` bytes is cut by length.
    """
    raw = np.flatnonzero(gear(data) >> np.uint32(32 - CUT_BITS) == 0)
    raw = raw[np.diff(raw, prepend=-LEAST_GAP) >= LEAST_GAP] + 1
    raw = raw[raw < len(data)]
    raw = raw[(data[raw] & 0xC0) != 0x80]
    ends = np.append(raw, len(data))
    sizes = np.diff(ends, prepend=0)
    if sizes.max(initial=0) > MOST:
        more = []
        for end, size in zip(ends.tolist(), sizes.tolist()):
            for at in range(end - size + MOST, end, MOST):
                while (data[at] & 0xC0) == 0x80:
                    at -= 1
                more.append(at)
        ends = np.sort(np.append(ends, more)).astype(np.int64)
    return ends


def digests(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit digest of every chunk: its bytes weighed by their place in it."""
    global _powers
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    if len(_powers) < sizes.max():
        steps = np.full(2 * int(sizes.max()), _STEP, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    sums = np.add.reduceat(_BYTE[data] * _powers[place], starts)
    return mix64(sums + sizes.astype(np.uint64) * U(0xA24BAED4963EE407)).view(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def table(parts: list[list]) -> pa.RecordBatch:
        rids, keys, chunks, found = parts
        sizes = [len(x) for x in chunks]
        names = pa.array(np.repeat(np.arange(len(keys)), sizes))
        columns = [pa.array(np.repeat(np.array(rids, np.int64), sizes)), pa.array(keys, pa.int64()).take(names)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(np.concatenate(chunks)), pa.array(np.concatenate(found))], schema=CHUNKS
        )

    for batch in batches:
        parts: list[list] = [[], [], [], []]
        held = 0
        for rid, doc, value in zip(*(c.to_pylist() for c in batch.columns)):
            if not value:
                continue
            data = np.frombuffer(value, np.uint8)
            ends = cuts(data)
            starts = np.concatenate([[0], ends[:-1]])
            for part, x in zip(parts, (rid, doc, starts << SIZE_BITS | ends - starts, digests(data, ends))):
                part.append(x)
            held += len(ends)
            if held >= ROWS_OUT:
                yield table(parts)
                parts, held = [[], [], [], []], 0
        if held:
            yield table(parts)


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around every match that are equal on both sides: rid, source, shift, start, end."""
    names = ["rid", "source", "shift", "start", "end"]
    for batch in batches:
        rids, sources, shifts, starts, sizes = (batch.column(i).to_numpy() for i in range(5))
        out: list[tuple] = []
        for i, (x, y) in enumerate(zip(batch.column(5), batch.column(6))):
            a, b = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
            start, size, shift = int(starts[i]), int(sizes[i]), int(shifts[i])
            # Where the match begins in either slice; the earlier text may begin sooner.
            at, there = min(start, REACH), min(start - shift, REACH)
            if (a[at : at + size] != b[there : there + size]).any():
                continue  # equal digests, other bytes
            left = min(at, there)
            differ = np.flatnonzero(a[at - left : at] != b[there - left : there])
            begin = at - left + (int(differ[-1]) + 1 if len(differ) else 0)
            right = min(len(a) - at, len(b) - there) - size
            differ = np.flatnonzero(a[at + size : at + size + right] != b[there + size : there + size + right])
            end = at + size + (int(differ[0]) if len(differ) else right)
            while begin < end and a[begin] & 0xC0 == 0x80:
                begin += 1
            while end < len(a) and begin < end and a[end] & 0xC0 == 0x80:
                end -= 1
            # A slice that ends within a character has no byte after it to tell.
            while end == len(a) and begin < end and not _whole(a[begin:end]):
                end -= 1
            out.append((int(rids[i]), int(sources[i]), shift, start - at + begin, start - at + end))
        columns = zip(*out) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _whole(data: np.ndarray) -> bool:
    """Whether the last character of some UTF-8 bytes is whole."""
    for back in range(1, min(4, len(data)) + 1):
        byte = int(data[-back])
        if byte & 0xC0 != 0x80:
            return back == (1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4)
    return False


def repeated_spans(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Spans of ``rows`` (rid, doc_id, text) to remove: rid, start and n_bytes in UTF-8, and
    source, the row that has the same bytes earlier.

    Earlier is a smaller doc_id (null first), of equal ones a smaller rid, in one row a
    smaller place. Of a digest the first place is the source of all others. Chunks of a
    row that are as far from their sources in one other row are a match from ``SEED``
    bytes on; it reaches over neighbouring bytes as long as they are equal, and is a span
    from ``min_bytes`` on. So a passage is found if it has that many whole chunks whose
    first places are in one earlier row. Spans of a row do not overlap: of two that do,
    the later one begins where the other ends.
    """
    texts = rows.select("rid", "doc_id", text_of().cast("binary").alias("text"))
    # Shuffled once: the first places and the join with them read the same files.
    chunks = texts.mapInArrow(_chunks, CHUNKS_DDL).repartition("digest")
    place = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "rid", "chunk")
    first = chunks.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    start = F.shiftright("chunk", SIZE_BITS)
    later = chunks.join(first.select("digest", "first"), "digest").filter(~place.eqNullSafe(F.col("first")))
    later = later.select(
        "rid",
        F.col("first.rid").alias("source"),
        (start - F.shiftright("first.chunk", SIZE_BITS)).alias("shift"),
        start.alias("start"),
        F.col("chunk").bitwiseAND(F.lit((1 << SIZE_BITS) - 1)).alias("size"),
    )
    later = save_step(later, "repeated_chunks")
    # Windows of one row and one source, at most the row's chunks.
    line = ["rid", "source", "shift"]
    order = Window.partitionBy(*line).orderBy("start")
    new = F.coalesce(F.lag(F.col("start") + F.col("size")).over(order) != F.col("start"), F.lit(True))
    matches = (
        later.withColumn("new", new.cast("int"))
        .withColumn("run", F.sum("new").over(order))
        .groupBy(*line, "run")
        .agg(F.min("start").alias("start"), F.sum("size").alias("size"))
        .filter(F.col("size") >= SEED)
        .drop("run")
    )
    matches = save_step(matches, "matches")
    around = F.col("size") + REACH
    # Named alike for both joins, by rid and by source, so that they read one shuffle of the texts.
    own = texts.select(F.col("rid").alias("r"), F.col("text").alias("t"))

    def cut(of: Column) -> Column:
        return F.substring("t", F.greatest(of - REACH, F.lit(0)).cast("int") + 1, (F.least(of, F.lit(REACH)) + around).cast("int"))

    x = matches.join(own, F.col("rid") == F.col("r")).select(*line, "start", "size", cut(F.col("start")).alias("x"))
    y = x.join(own, F.col("source") == F.col("r")).select(
        *line, "start", "size", "x", cut(F.col("start") - F.col("shift")).alias("y")
    )
    known = y.mapInArrow(_extend, "rid BIGINT, source BIGINT, shift BIGINT, start BIGINT, `end` BIGINT")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    joined = (
        known.withColumn("new", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("new").over(order))
        .groupBy(*line, "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .filter(F.col("end") - F.col("start") >= min_bytes)
    )
    by_row = Window.partitionBy("rid").orderBy("start", "end", "source", "shift")
    taken = F.coalesce(F.max("end").over(by_row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        joined.withColumn("begin", F.greatest("start", taken))
        .filter("begin < `end`")
        .select("rid", F.col("begin").alias("start"), (F.col("end") - F.col("begin")).alias("n_bytes"), "source")
    )


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """One row per span to remove: doc_id, start, n_bytes (UTF-8), first_doc_id.

    The bytes of a span stand in the document ``first_doc_id`` as well, which is earlier
    by key, or before it in the same one. Rows that repeat are rows of their own: the
    second is a span from end to end.
    """
    rows = numbered(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")), "passages")
    found = repeated_spans(rows, min_bytes)
    names = rows.select("rid", "doc_id")
    firsts = names.select(F.col("rid").alias("source"), F.col("doc_id").alias("first_doc_id"))
    return found.join(names, "rid").join(firsts, "source").select("doc_id", "start", "n_bytes", "first_doc_id")


def drop_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Per row: doc_id, removed_bytes and the text without its repeated passages; null stays null."""
    rows = numbered(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")), "passages")
    # At most as many spans as a row has chunks.
    gone = repeated_spans(rows, min_bytes).groupBy(F.col("rid").alias("r")).agg(
        F.sort_array(F.collect_list(F.struct("start", "n_bytes"))).alias("gone")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, texts = [], []
            for value, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, parts, at = (value or "").encode(), [], 0
                for span in found or []:
                    parts.append(data[at : span["start"]])
                    at = span["start"] + span["n_bytes"]
                kept = b"".join([*parts, data[at:]])
                removed.append(len(data) - len(kept))
                texts.append(None if value is None else kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "removed_bytes", "text"],
            )

    joined = rows.join(gone, F.col("rid") == F.col("r"), "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(cut, "doc_id BIGINT, removed_bytes BIGINT, text STRING")
