"""Records of files that no line break delimits, cut by many tasks.

Spark's text reader splits a file into blocks at any separator. Whether a separator
ends a record depends on all that stands before it, so there are three steps:

1. Every block is summed up for each state that it may begin in.
2. A prefix scan over the blocks of a file, one row each, tells every block's state.
3. Every block is cut. What reaches over its ends is numbered like its other half and
   put together; only these pieces, two for each block, are shuffled.

``json_records`` cuts a document at the commas between the elements of its list, or
between the members of its object and the elements in them; ``csv_records`` cuts a
table at line breaks outside quotes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnmill.session import save_step

BROADCAST_BLOCKS = 50_000  # block states that are sent to all tasks, about 200 bytes each

FILE, BLOCK = "_file", "_block"
PART_DDL = f"{FILE} STRING, {BLOCK} BIGINT, i BIGINT, level INT, head BOOLEAN, tail BOOLEAN, value BINARY"
PART_NAMES = [FILE, BLOCK, "i", "level", "head", "tail", "value"]
PART_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
ROWS_OUT = 5_000


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """The text between separators, with its file and block; in order within a block."""
    rows = spark.read.option("lineSep", separator).text(path)
    return rows.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("value").cast("binary").alias("value"),
    )


def runs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, list[bytes]]]:
    """Neighbouring rows that agree in the first columns: these and the pieces."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        blocks = batch.column(1).to_numpy()
        files = batch.column(0).dictionary_encode().indices.to_numpy()
        new = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(files) != 0)) + 1
        edges = [0, *new.tolist(), n]
        values = batch.column(columns).to_pylist()
        for start, end in zip(edges, edges[1:]):
            yield tuple(batch.column(c)[start].as_py() for c in range(columns)), values[start:end]


# --- JSON ---------------------------------------------------------------------


def structure(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """For every byte: whether it stands in a string, and what it adds to the depth.

    ``inside`` says whether the first byte stands in a string. A string's own quotes
    count as in it or not, which nothing depends on.
    """
    back = data == 0x5C
    quote = np.flatnonzero(data == 0x22)
    if back.any() and len(quote):
        # A quote after an odd number of backslashes is part of the string.
        place = np.where(back, -1, np.arange(len(data)))
        before = np.maximum.accumulate(place)
        run = np.where(quote > 0, quote - 1 - before[np.maximum(quote - 1, 0)], 0)
        run = np.where((quote > 0) & (before[np.maximum(quote - 1, 0)] < 0), quote, run)
        quote = quote[run % 2 == 0]
    mark = np.zeros(len(data), np.int64)
    mark[quote] = 1
    within = (np.cumsum(mark) + inside) & 1 == 1
    opens = (data == 0x7B) | (data == 0x5B)
    closes = (data == 0x7D) | (data == 0x5D)
    return within, np.where(within, 0, opens.astype(np.int64) - closes)


def _json_summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: quotes, depth gained from either state, and its first character."""
    now, found = None, [0, 0, 0, None]

    def row() -> pa.RecordBatch:
        values = [*now, found[0] & 1, found[1], found[2], found[3]]
        names = [FILE, BLOCK, "parity", "gain_out", "gain_in", "opens"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    for block, values in runs(batches, 2):
        if block != now:
            if now is not None:
                yield row()
            now, found = block, [0, 0, 0, None]
        text = b",".join(values) + b","
        if found[3] is None:
            first = text.removeprefix(b"\xef\xbb\xbf").lstrip()[:1]
            found[3] = first.decode("latin-1") if first else None
        data = np.frombuffer(text, np.uint8)
        within, gain = structure(data, False)
        other = structure(data, True)[1]
        odd = found[0] & 1
        found[1] += int((other if odd else gain).sum())
        found[2] += int((gain if odd else other).sum())
        found[0] += int(within[-1])
    if now is not None:
        yield row()


def _states(blocks: DataFrame) -> DataFrame:
    """Every block's state: inside a string, depth, what its file opens with, and if it is the last."""
    order = Window.partitionBy(FILE).orderBy(BLOCK)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(FILE)
    zero = F.lit(0).cast("bigint")
    inside = F.coalesce(F.sum("parity").over(before), zero) % 2
    gain = F.when(F.col("inside") == 1, F.col("gain_in")).otherwise(F.col("gain_out"))
    return (
        blocks.withColumn("inside", inside.cast("int"))
        .withColumn("depth", F.coalesce(F.sum(gain).over(before), zero))
        .withColumn("kind", F.min_by("opens", F.when(F.col("opens").isNotNull(), F.col(BLOCK))).over(every))
        .withColumn("last", F.col(BLOCK) == F.max(BLOCK).over(every))
        .select(FILE, BLOCK, "inside", "depth", "kind", "last")
    )


def _json_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts between the commas of a list, or of an object and what is in it."""
    now, out = None, []
    inside = depth = number = level = 0
    head, held, last, levels = False, [], False, (1,)

    def batch() -> pa.RecordBatch:
        rows = list(zip(*out)) if out else [[]] * len(PART_NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, PART_TYPES)], names=PART_NAMES)

    def end() -> None:
        text = b"".join(held)
        if last:
            out.append((*now[:2], number, level, head, False, text[:-1]))  # the comma was not there
        elif text:
            out.append((*now[:2], number, level, head, True, text))

    for block, values in runs(batches, 6):
        if block != now:
            if now is not None:
                end()
            now, number, held = block, 0, []
            _, start, inside, depth, kind, last = block
            levels = (1, 2) if kind == "{" else (1,)
            head = start > 0 and (inside == 1 or depth not in levels)
            level = depth if start else 1
        text = b",".join(values) + b","
        data = np.frombuffer(text, np.uint8)
        within, gain = structure(data, inside == 1)
        depths = depth + np.cumsum(gain)
        comma = (data == 0x2C) & ~within & (depths == 1 if len(levels) == 1 else (depths == 1) | (depths == 2))
        at = 0
        for p in np.flatnonzero(comma).tolist():
            held.append(text[at:p])
            out.append((*now[:2], number, level, head, False, b"".join(held)))
            held, head, number, level, at = [], False, number + 1, int(depths[p]), p + 1
            if len(out) >= ROWS_OUT:
                yield batch()
                out.clear()
        held.append(text[at:])
        inside, depth = int(within[-1]), int(depths[-1])
    if now is not None:
        end()
    yield batch()


# --- CSV ----------------------------------------------------------------------


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted cell is open after a line, given whether one is before it.

    A quote opens a cell only as its first character; in it, two stand for one.
    """
    if b'"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == b'"':
                at += 2
                continue
            inside = False
        elif line[at : at + 1] == b'"':
            inside, at = True, at + 1
            continue
        at = line.find(b",", at)
        if at < 0:
            return False
        at += 1


def _csv_summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: whether a cell is open at its end, if none or one is open at its start."""
    now, state = None, [False, True]

    def row() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        values = zip([*now, *state], kinds)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in values], names=[FILE, BLOCK, "out", "in"])

    for block, values in runs(batches, 2):
        if block != now:
            if now is not None:
                yield row()
            now, state = block, [False, True]
        for line in values:
            if b'"' in line:
                state = [ends_inside(line, s) for s in state]
    if now is not None:
        yield row()


def _csv_states(blocks: DataFrame) -> DataFrame:
    """Every block's state, from the last block before it that ends alike from both states
    and the number of blocks since then that turn the state round."""
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("out") & ~F.col("in")).cast("int")
    counted = blocks.withColumn("turns", F.coalesce(F.sum(turns).over(before), F.lit(0).cast("bigint")))
    sure = F.when(F.col("out") == F.col("in"), F.struct(F.col(BLOCK), F.col("out").cast("int").alias("out"), F.col("turns")))
    known = F.max(sure).over(before)
    inside = (F.coalesce(known["out"], F.lit(0)) + F.col("turns") - F.coalesce(known["turns"], F.lit(0))) % 2
    last = F.col(BLOCK) == F.max(BLOCK).over(Window.partitionBy(FILE))
    return counted.select(FILE, BLOCK, inside.cast("int").alias("inside"), last.alias("last"))


def _csv_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of a block; lines without text between records are none."""
    now, out, held = None, [], []
    inside = head = last = False
    number = 0

    def batch() -> pa.RecordBatch:
        rows = list(zip(*out)) if out else [[]] * len(PART_NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, PART_TYPES)], names=PART_NAMES)

    def end() -> None:
        if held:
            text = b"\n".join(held)
            out.append((*now[:2], number, 0, head, not last, text if last else text + b"\n"))

    for block, values in runs(batches, 4):
        if block != now:
            if now is not None:
                end()
            now, number, held = block, 0, []
            inside, last = block[2] == 1, block[3]
            head = inside
        for line in values:
            inside = ends_inside(line, inside)
            if inside or held or head:
                held.append(line)
                if inside:
                    continue
                line = b"\n".join(held)
                held = []
            elif not line or line == b"\r":
                continue
            out.append((*now[:2], number, 0, head, False, line))
            head, number = False, number + 1
            if len(out) >= ROWS_OUT:
                yield batch()
                out.clear()
    if now is not None:
        end()
    yield batch()


# --- both ---------------------------------------------------------------------


def _with_states(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Pieces with their block's state, in order within a block."""
    names = [c for c in states.columns if c not in (FILE, BLOCK)]
    if states.count() <= BROADCAST_BLOCKS:
        return rows.join(F.broadcast(states), [FILE, BLOCK]).select(FILE, BLOCK, *names, "value")
    # Too many to send: the pieces of a block meet its state, and are put in order again.
    placed = rows.withColumn("_place", F.monotonically_increasing_id()).join(states, [FILE, BLOCK])
    ordered = placed.repartition(FILE, BLOCK).sortWithinPartitions(FILE, BLOCK, "_place")
    return ordered.select(FILE, BLOCK, *names, "value")


def _records(spark: SparkSession, path: str, separator: str, summary, summary_ddl: str, states, parts) -> DataFrame:
    """_file, _row (from 0 in every file), level and value of every record."""
    rows = pieces(spark, path, separator)
    known = save_step(states(rows.mapInArrow(summary, f"{FILE} STRING, {BLOCK} BIGINT, {summary_ddl}")), "block_states")
    cut = save_step(_with_states(rows, known).mapInArrow(parts, PART_DDL), "block_parts")
    ends = cut.groupBy(FILE, BLOCK).agg(F.count_if(~F.col("tail")).alias("n"))
    before = F.sum("n").over(Window.partitionBy(FILE).orderBy(BLOCK)) - F.col("n")
    numbered = cut.join(ends.select(FILE, BLOCK, before.alias("first")), [FILE, BLOCK]).select(
        FILE, BLOCK, (F.col("first") + F.col("i")).alias("_row"), "level", "head", "tail", "value"
    )
    whole = numbered.filter("NOT head AND NOT tail").select(FILE, "_row", "level", "value")
    # Parts that reach over the end of a block: two for each block at most.
    joined = (
        numbered.filter("head OR tail")
        .groupBy(FILE, "_row")
        .agg(F.array_sort(F.collect_list(F.struct(BLOCK, "level", "value"))).alias("parts"))
        .select(
            FILE,
            "_row",
            F.col("parts")[0]["level"].alias("level"),
            F.aggregate("parts", F.lit(b""), lambda text, p: F.concat(text, p["value"])).alias("value"),
        )
    )
    return whole.unionAll(joined).withColumn("value", F.col("value").cast("string"))


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """The parts of every document: _file, _row, level, value.

    ``value`` still has the brackets of the document itself. ``level`` is the depth of
    the comma before a part: 1 in a list, or before a member of an object; 2 before
    another element of a member's value.
    """
    summary = "parity INT, gain_out BIGINT, gain_in BIGINT, opens STRING"
    return _records(spark, path, ",", _json_summary, summary, _states, _json_parts)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of every table, the header as record 0: _file, _row, level, value."""
    return _records(spark, path, "\n", _csv_summary, "`out` BOOLEAN, `in` BOOLEAN", _csv_states, _csv_parts)
