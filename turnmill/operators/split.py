"""Exact train/test splits.

A split needs the k-th smallest key, not a sort. The key's position is found by
counting rows per bucket and descending into the one bucket that holds it, so
the driver sees a few thousand counts per step and the rows themselves are only
compared with one literal: no row is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.operators.positions import distance, number_rows

TRAIN_RATIO = 0.8
TEST_RATIO = 0.2
SEED = 42
PREFIX = 4  # hex characters per descent: at most 65,536 counts
SMALL = 4096  # buckets of this many rows are finished off directly
MISSING_LABEL = "unknown"


def shuffle_key(key: str | Column, seed: int = SEED) -> Column:
    """Hash that stands in for a seeded shuffle: same order on any cluster."""
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed)), col.cast("string")))


def split_order(key: str, seed: int = SEED, shuffle: bool = True) -> Column:
    """A sortable, unique value that puts rows in the order the split took them."""
    if not shuffle:
        return F.col(key)
    return F.concat_ws(":", shuffle_key(key, seed), F.col(key).cast("string"))


def _kth_hash(df: DataFrame, key: str, seed: int, k: int) -> tuple[str, int] | None:
    """(hash, key) of the k-th row in shuffled order; None for k = 0."""
    if k <= 0:
        return None
    rows = df.select(shuffle_key(key, seed).alias("h"), F.col(key).alias("k"))
    prefix, left = "", k
    while True:
        here = rows.filter(F.startswith("h", F.lit(prefix))) if prefix else rows
        piece = F.substring("h", len(prefix) + 1, PREFIX)
        counts = sorted(tuple(r) for r in here.groupBy(piece.alias("p")).count().collect())
        for p, n in counts:
            if left <= n:
                prefix, size = prefix + p, n
                break
            left -= n
        else:
            raise ValueError("k exceeds the number of rows")
        if size <= SMALL:
            inside = rows.filter(F.startswith("h", F.lit(prefix))).collect()
            return tuple(sorted(tuple(r) for r in inside)[left - 1])
        if len(prefix) >= 32:
            raise ValueError(f"column {key!r} must be unique to split on it")


def _kth_value(df: DataFrame, key: str, k: int) -> int | None:
    """The k-th smallest integer key; None for k = 0."""
    if k <= 0:
        return None
    low, high = df.agg(F.min(key), F.max(key)).first()
    left = k
    while high > low:
        width = (high - low) // SMALL + 1
        bucket = F.expr(f"{distance(key, low, high)} DIV {width}")
        inside = df.filter(F.col(key).between(low, high))
        counts = sorted(tuple(r) for r in inside.groupBy(bucket.alias("b")).count().collect())
        for b, n in counts:
            if left <= n:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            left -= n
    return low


def _before(df: DataFrame, key: str, seed: int, shuffle: bool, k: int) -> Column:
    """Condition true for exactly the first ``k`` rows of the split order."""
    if shuffle:
        cut = _kth_hash(df, key, seed, k)
        if cut is None:
            return F.lit(False)
        h = shuffle_key(key, seed)
        return (h < cut[0]) | ((h == cut[0]) & (F.col(key) <= cut[1]))
    last = _kth_value(df, key, k)
    return F.lit(False) if last is None else F.col(key) <= F.lit(last)


def train_test_split(
    df: DataFrame,
    key: str = "pos",
    train_ratio: float = TRAIN_RATIO,
    seed: int = SEED,
    shuffle: bool = True,
) -> DataFrame:
    """Label rows ``train`` or ``test`` in column ``split``.

    Exactly ``int(n * train_ratio)`` rows go to train: the first ones in hash
    order, or in order of the unique integer ``key`` without shuffle.
    """
    train_size = int(df.count() * train_ratio)
    first = _before(df, key, seed, shuffle, train_size)
    return df.withColumn("split", F.when(first, "train").otherwise("test"))


def subsample_test(
    split: DataFrame, key: str = "pos", seed: int = SEED, shuffle: bool = True
) -> DataFrame:
    """All train rows and the first min(test, train // 10) test rows in split order."""
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    k = min(sizes.get("test", 0), sizes.get("train", 0) // 10)
    test = split.filter(F.col("split") == "test")
    kept = _before(test, key, seed, shuffle, k)
    return split.filter((F.col("split") == "train") | kept)


def _train_quotas(totals: DataFrame, n: int, n_train: int) -> DataFrame:
    """Rows per label for train: proportional, whole parts, then largest remainders."""
    share = F.col("n") / F.lit(float(n)) * F.lit(float(n_train))
    base = totals.withColumn("floor", F.floor(share)).withColumn("rest", share - F.floor(share))
    spare = n_train - base.agg(F.sum("floor")).first()[0]
    # Labels may be as many as half of the rows, so they are numbered in ranges.
    placed = number_rows(base, F.desc("rest"), F.asc("label"), out="place")
    extra = F.when(F.col("place") < F.lit(spare), 1).otherwise(0)
    return placed.select("label", (F.col("floor") + extra).alias("quota"))


def stratified_split(
    df: DataFrame,
    label: str = "category",
    key: str = "pos",
    test_ratio: float = TEST_RATIO,
    train_ratio: float = TRAIN_RATIO,
    seed: int = SEED,
    shuffle: bool = True,
) -> DataFrame:
    """Split so that every label keeps its share in train and test.

    ``ceil(n * test_ratio)`` rows go to test. Rows without a label count as
    ``unknown``. Without the label column this is :func:`train_test_split`.
    A label may hold any share of the rows: its cut point is found from counts
    per (label, hash prefix), so no label is gathered in one task.
    """
    if label not in df.columns:
        return train_test_split(df, key, train_ratio, seed, shuffle)
    if not shuffle:
        raise ValueError("a stratified split needs shuffle=True")
    name = F.coalesce(F.col(label).cast("string"), F.lit(MISSING_LABEL))
    rows = df.select(
        name.alias("label"), shuffle_key(key, seed).alias("h"), F.col(key).alias("k")
    ).withColumn("b", F.substring("h", 1, PREFIX))
    counts = rows.groupBy("label", "b").agg(F.count("*").alias("m"))
    totals = counts.groupBy("label").agg(F.sum("m").alias("n"))
    n, classes, smallest = totals.agg(F.sum("n"), F.count("*"), F.min("n")).first()
    n_test = math.ceil((n or 0) * test_ratio)
    n_train = (n or 0) - n_test
    if not n or smallest < 2:
        raise ValueError("every label needs at least two rows")
    if min(n_train, n_test) < classes:
        raise ValueError("train and test each need at least one row per label")
    quotas = _train_quotas(totals, n, n_train)
    # At most 65,536 counts per label enter this window.
    running = F.sum("m").over(Window.partitionBy("label").orderBy("b"))
    edge = (
        counts.withColumn("upto", running)
        .join(quotas, "label")
        .filter((F.col("quota") <= F.col("upto")) & (F.col("quota") > F.col("upto") - F.col("m")))
        .select("label", "b", (F.col("quota") - F.col("upto") + F.col("m")).alias("take"))
    )
    # Only the one bucket per label that holds the cut is ordered.
    rank = F.row_number().over(Window.partitionBy("label", "b").orderBy("h", "k"))
    cuts = (
        rows.join(edge, ["label", "b"])
        .withColumn("r", rank)
        .filter(F.col("r") == F.col("take"))
        .select(F.col("label").alias("_label"), F.struct("h", "k").alias("_cut"))
    )
    own = F.struct(shuffle_key(key, seed).alias("h"), F.col(key).alias("k"))
    return (
        df.join(cuts, name == F.col("_label"), "left")
        .withColumn("split", F.when(own <= F.col("_cut"), "train").otherwise("test"))
        .drop("_label", "_cut")
    )


def split_statistics(split: DataFrame) -> DataFrame:
    """One row: total, per-split counts and ratios (NULL when there are no rows)."""
    train = F.count_if(F.col("split") == "train")
    test = F.count_if(F.col("split") == "test")
    total = F.count("*")
    safe = F.when(total > 0, total)
    return split.agg(
        total.alias("total_samples"),
        train.alias("train_samples"),
        test.alias("test_samples"),
        (train / safe).alias("train_ratio"),
        (test / safe).alias("test_ratio"),
    )


def field_statistics(
    split: DataFrame,
    sample: str = "sample",
    key: str = "pos",
    first_row_only: bool = False,
) -> DataFrame:
    """One row per field: ``common``, ``train_only`` or ``test_only``.

    Fields are the keys of the JSON samples over all rows; ``first_row_only``
    looks at the earliest row of each split.
    """
    if first_row_only:
        split = split.groupBy("split").agg(F.min_by(sample, key).alias(sample))
    fields = split.select("split", F.explode(F.json_object_keys(sample)).alias("field"))
    in_train = F.bool_or(F.col("split") == "train")
    in_test = F.bool_or(F.col("split") == "test")
    return fields.groupBy("field").agg(
        F.when(in_train & in_test, "common")
        .when(in_train, "train_only")
        .otherwise("test_only")
        .alias("presence")
    )
