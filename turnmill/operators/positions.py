"""Dense row positions without a global sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.session import save_step

ROW_BITS = 33  # row number bits of monotonically_increasing_id
BROADCAST_ROWS = 100_000  # about 200 bytes each


def with_positions(frames: list[DataFrame], out: str = "pos") -> DataFrame:
    """Union of frames with positions 0..n-1: frame by frame, in the order of their files.

    Rows of a file source carry ``_file`` and ``_block`` (dropped here): their
    order is that of the file names, of the blocks in a file and of the rows in a
    block, however blocks were packed into tasks. Rows with ``_file`` and ``_row``, their
    place in the file, have their order already. Other frames keep scan order.
    One count per block gives it its offset; rows never move. The frames must give
    the same rows whenever they are computed.
    """
    spark = frames[0].sparkSession
    part = F.shiftright("_id", ROW_BITS)
    tagged = []
    for i, f in enumerate(frames):
        if "_file" not in f.columns:
            f = f.withColumn("_id", F.monotonically_increasing_id())
            f = f.withColumn("_file", F.lit("")).withColumn("_block", part).drop("_id")
        if "_row" in f.columns:  # numbered by its reader
            f = f.withColumn("_block", F.lit(0).cast("bigint"))
            tagged.append(f.withColumnRenamed("_row", "_id").withColumn("_f", F.lit(i)))
        else:
            tagged.append(f.select(F.lit(i).alias("_f"), F.monotonically_increasing_id().alias("_id"), "*"))
    rows = reduce(DataFrame.unionByName, tagged)
    block = ["_f", "_file", "_block"]
    counts = rows.groupBy(*block).agg(F.min("_id").alias("first"), F.count("*").alias("n")).collect()
    offsets, total = [], 0
    for f, file, start, first, n in sorted(tuple(c) for c in counts):
        offsets.append((f, file, start, total - first))
        total += n
    schema = T.StructType.fromDDL("_f INT, _file STRING, _block BIGINT, _off BIGINT")
    table = spark.createDataFrame(offsets, schema)
    if len(offsets) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    return (
        rows.join(table, block)
        .withColumn(out, F.col("_off") + F.col("_id"))
        .drop(*block, "_id", "_off")
    )


def distance(key: str, low: int, high: int) -> str:
    """SQL for the distance of an integer key from ``low``; exact on any range."""
    wide = high - low >= 1 << 63
    return f"(cast(`{key}` as decimal(20,0)) - ({low}))" if wide else f"(`{key}` - ({low}))"


def number_rows(df: DataFrame, *order: str | Column, out: str = "rank") -> DataFrame:
    """0-based place of each row in ``order``, which must be unique.

    Spark cuts the rows into ranges of about equal size, whatever the values are,
    and sorts each. They are written once, so that the counts of the ranges, which
    become their offsets, belong to the very rows that are numbered.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    rows = save_step(
        ranged.withColumns({"_range": F.spark_partition_id(), "_place": inside}), "ranges"
    )
    sizes = rows.groupBy("_range").agg(F.count("*").alias("n"))
    # One count per shuffle partition enters this window and the broadcast below.
    before = F.sum("n").over(Window.orderBy("_range")) - F.col("n")
    offsets = sizes.select("_range", before.alias("_off"))
    return (
        rows.join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_off") + F.col("_place"))
        .drop("_range", "_place", "_off")
    )


def with_rank(df: DataFrame, key: str = "pos", out: str = "rank") -> DataFrame:
    """0-based rank of a unique integer key, by ranges of equal size."""
    return number_rows(df, key, out=out)


def batch_numbers(
    df: DataFrame, key: str = "pos", batch_size: int = 16, out: str = "batch"
) -> DataFrame:
    """1-based batch of each row when rows are taken ``batch_size`` at a time."""
    ranked = with_rank(df, key, "_rank")
    return ranked.withColumn(out, F.expr(f"_rank DIV {batch_size} + 1")).drop("_rank")
