"""Hard negatives by vertical scans of embeddings.

Vectors lie in blocks, a block's components in columns. An anchor reads the
columns in order of its own components' magnitude, largest first. The columns not
yet read can add no less and no more than their least and greatest values allow;
rows that these bounds rule out leave the bitmap of candidates, and the scores of
those that remain are complete when all columns are read.

A first scan finds each anchor's nearest rows of the same label, its positives. A
second scan finds the best rows of other labels in the window of scores that each
positive sets. Every scan meets a part of the anchors with one block of rows in one
task; both have a fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import numbered
from turnmill.session import save_step

POSITIVES = 5
NEGATIVES = 3
LOWEST, HIGHEST = 50, 95  # percent of the positive's score that a negative may have
BLOCK = 8_192  # rows of a block
ANCHORS = 8_192  # anchors that meet a block in one task
COLUMNS = 16  # columns that are read between two looks at the bounds
LONG = 1 << 63


def whole(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    lists = vectors.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    rows = np.zeros((len(sizes), width), np.int64)
    rows[np.arange(width) < sizes[:, None]] = flat
    return rows


def width_of(*vectors: pa.ChunkedArray) -> int:
    return max((int(np.diff(v.combine_chunks().offsets.to_numpy()).max(initial=0)) for v in vectors), default=0)


@dataclass
class Columns:
    """A block of rows of one label: a column per component, each column's ends."""

    values: np.ndarray
    least: np.ndarray
    greatest: np.ndarray


def number_type(a: np.ndarray, b: np.ndarray) -> type:
    """The narrowest type that holds all sums of products of the components exactly."""
    most = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    bound = most[0] * most[1] * max(1, a.shape[1])
    return np.int32 if bound < 1 << 30 else np.int64 if bound < 1 << 61 else object


class Scan:
    """One anchor over one block of columns, a few columns at a time."""

    def __init__(self, query: np.ndarray, block: Columns, rows: np.ndarray | None = None):
        self.block = block
        self.query = query
        self.order = np.argsort(-np.abs(query.astype(np.float64)), kind="stable")
        ends = np.stack([query * block.least, query * block.greatest])[:, self.order]
        # What the columns from a place on can add, at least and at most.
        self.rest = [np.append(np.cumsum(e[::-1])[::-1], 0) for e in (ends.min(axis=0), ends.max(axis=0))]
        self.rows = np.arange(block.values.shape[1]) if rows is None else rows
        self.sums = np.zeros(len(self.rows), query.dtype)
        self.read = 0

    def more(self) -> bool:
        """Read the next columns for the rows that are left; false when all are read."""
        if self.read >= len(self.order):
            return False
        every = len(self.rows) == self.block.values.shape[1]
        for i in self.order[self.read : self.read + COLUMNS]:
            column = self.block.values[i]
            self.sums += self.query[i] * (column if every else column[self.rows])
        self.read = min(self.read + COLUMNS, len(self.order))
        return self.read < len(self.order)

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        return self.sums + self.rest[0][self.read], self.sums + self.rest[1][self.read]

    def keep(self, mask: np.ndarray) -> None:
        if not mask.all():
            self.rows, self.sums = self.rows[mask], self.sums[mask]


def nearest(query: np.ndarray, block: Columns, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be among the ``count`` best of the block, ties included, and scores."""
    scan = Scan(query, block)
    while scan.more():
        if len(scan.rows) > count:
            low, high = scan.bounds()
            scan.keep(high >= np.partition(low, len(low) - count)[len(low) - count])
    return scan.rows, scan.sums


def in_windows(
    query: np.ndarray, block: Columns, rows: np.ndarray, windows: list[tuple[int, int]], count: int
) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``rows`` that can be among the ``count`` best of some window of scores, and scores.

    Of a window, rows that lie in it for certain set the level that others must reach.
    """
    scan = Scan(query, block, rows)
    while scan.more():
        low, high = scan.bounds()
        wanted = np.zeros(len(scan.rows), bool)
        for least, most in windows:
            sure = low[(low >= least) & (high <= most)]
            if len(sure) > count:
                least = max(least, np.partition(sure, len(sure) - count)[len(sure) - count])
            wanted |= (high >= least) & (low <= most)
        scan.keep(wanted)
    return scan.rows, scan.sums


def best(scores: np.ndarray, ids: np.ndarray, places: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` by score, then id with nulls last, then place."""
    if len(scores) > 4 * count:
        level = np.partition(scores, len(scores) - count)[len(scores) - count]
        few = np.flatnonzero(scores >= level)
    else:
        few = np.arange(len(scores))
    ranked = sorted(few.tolist(), key=lambda i: (-int(scores[i]), ids[i] is None, ids[i] or 0, places[i]))
    return np.array(ranked[:count], np.int64)


def columns(matrix: np.ndarray) -> Columns:
    values = np.ascontiguousarray(matrix.T)
    return Columns(values, values.min(axis=1), values.max(axis=1))


def _cells(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Components of both sides as numbers that hold every score."""
    width = width_of(rows["v"], anchors["v"])
    both = [whole(t["v"], width) for t in (rows, anchors)]
    kind = number_type(*both)
    return both[0].astype(kind), both[1].astype(kind)


def _long(value: int) -> int:
    return max(-LONG, min(LONG - 1, int(value)))


FOUND = pa.schema(
    [
        ("anchor", pa.int64()),
        ("window", pa.int32()),
        ("row", pa.int64()),
        ("id", pa.int64()),
        ("score", pa.int64()),
    ]
)
FOUND_DDL = "anchor BIGINT, window INT, row BIGINT, id BIGINT, score BIGINT"


def mine(
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    block: int = BLOCK,
) -> DataFrame:
    """Hard negatives of all anchors: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    ``anchor`` is a condition on ``rows``; ``label`` an integer column, by default
    ``label``. A component x counts as floor(256 * x). The score of two rows is the inner
    product; higher scores come first, ties by smaller key, null keys last. The first
    ``positives`` other rows of the anchor's label are its positives. Of the rows of other
    labels whose score is ``lowest`` to ``highest`` percent of a positive's, the first
    ``negatives`` are returned; a positive without any has no row.

    Rows with a null label, a null vector or a component that is null or not finite take
    no part. Rows that repeat are rows of their own, also as anchors. Missing components
    of shorter vectors are 0. Scores are exact and ordered as such; one beyond 64 bits is
    returned, and sets its window, as the least or greatest long. Components beyond 64 bits
    are cut off there.
    """
    label = F.col("label") if label is None else label
    sound = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    whole_vector = F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("bigint"))
    parts = rows.select(
        F.col(key).cast("bigint").alias("id"),
        label.cast("int").alias("label"),
        F.when(sound, whole_vector).alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    )
    parts = numbered(parts.filter("label IS NOT NULL AND v IS NOT NULL"), "vectors")
    n, n_anchors = parts.agg(F.count("*"), F.count_if("is_anchor")).first()
    n_blocks, n_parts = max(1, -(-n // block)), max(1, -(-n_anchors // ANCHORS))
    spread = F.xxhash64("rid")
    blocks = parts.select("rid", "id", "label", "v", F.pmod(spread, F.lit(n_blocks)).alias("block"))
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    # Columns of their own: a cogroup of two parts of one table confuses equal ones.
    own = [F.col(c).alias(c) for c in ("rid", "id", "label", "v")]
    chosen = parts.filter("is_anchor").select(*own, F.pmod(spread, F.lit(n_parts)).cast("int").alias("part"))

    def meet(anchors: DataFrame, scan) -> DataFrame:
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))
        to_all = anchors.withColumn("block", F.explode(every))
        return blocks.groupBy("block", "part").cogroup(to_all.groupBy("block", "part")).applyInArrow(scan, FOUND_DDL)

    def table(found: list[tuple]) -> pa.Table:
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*found) if found else [[]] * len(FOUND), FOUND)], schema=FOUND
        )

    def find_positives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return table([])
        matrix, queries = _cells(rows, anchors)
        labels = rows["label"].to_numpy()
        by_label = {}
        for value in np.unique(labels).tolist():
            places = np.flatnonzero(labels == value)
            by_label[value] = places, columns(matrix[places])
        ids, rids = rows["id"].to_pylist(), rows["rid"].to_numpy()
        found = []
        for me, its_label, query in zip(anchors["rid"].to_pylist(), anchors["label"].to_pylist(), queries):
            if its_label not in by_label:
                continue
            places, block = by_label[its_label]
            near, scores = nearest(query, block, positives + 1)  # the anchor itself may be one
            others = rids[places[near]] != me
            near, scores = places[near[others]], scores[others]
            for i in best(scores, [ids[p] for p in near], rids[near], positives):
                p = near[i]
                found.append((me, 0, int(rids[p]), ids[p], _long(scores[i])))
        return table(found)

    def first(found: DataFrame, group: list[str], count: int, out: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
        return found.withColumn(out, F.row_number().over(order)).filter(F.col(out) <= count)

    near = first(meet(chosen, find_positives), ["anchor"], positives, "window")
    near = save_step(near.select("anchor", "window", F.col("id").alias("positive_id"), "score"), "positives")
    by_anchor = near.groupBy(F.col("anchor").alias("rid")).agg(
        F.array_sort(F.collect_list(F.struct("window", "score"))).alias("windows")  # at most ``positives``
    )

    def find_negatives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return table([])
        matrix, queries = _cells(rows, anchors)
        block, labels = columns(matrix), rows["label"].to_numpy()
        others = {value: np.flatnonzero(labels != value) for value in set(anchors["label"].to_pylist())}
        ids, rids = rows["id"].to_pylist(), rows["rid"].to_numpy()
        found = []
        own = zip(anchors["rid"].to_pylist(), anchors["label"].to_pylist(), anchors["windows"].to_pylist(), queries)
        for me, its_label, positive, query in own:
            limits = [(-(-w["score"] * lowest // 100), w["score"] * highest // 100) for w in positive]
            some = [w for w in limits if w[0] <= w[1]]
            if not some:
                continue
            near, scores = in_windows(query, block, others[its_label], some, negatives)
            for (least, most), w in zip(limits, positive):
                inside = np.flatnonzero((scores >= least) & (scores <= most))
                there = near[inside]
                for i in best(scores[inside], [ids[p] for p in there], rids[there], negatives):
                    p = there[i]
                    found.append((me, w["window"], int(rids[p]), ids[p], _long(scores[inside][i])))
        return table(found)

    far = first(meet(chosen.join(by_anchor, "rid"), find_negatives), ["anchor", "window"], negatives, "rank")
    far = far.select("anchor", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = parts.select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        far.join(near.withColumnRenamed("score", "positive_score"), ["anchor", "window"])
        .join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
