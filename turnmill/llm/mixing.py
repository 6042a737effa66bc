"""Mixing sources to target weights by weighted fair queueing.

Every source sends its documents in a shuffled order, up to ``repeats`` times.
A copy's virtual finish time is the source's tokens so far divided by the
source's target. The mix takes copies by finish time until the budget is used.
Only keys, sizes and times are sorted; sums are taken per hash bucket of a
source, so a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import WORD, numbered, text_of
from turnmill.session import save_step

REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 17
SLICES = 4096  # hash buckets of a source; slices of virtual time


def word_count(text: str = "text") -> Column:
    return F.size(F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Per source: place, weight, source_size, target.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum
    of all sizes. No target exceeds ``repeats`` times its source; what that cuts
    off is shared again by weight. In order of the limit per weight the limited
    sources are a prefix, so one pass over the sources finds the level.
    The windows hold one row per source, not per document.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order)
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") - 1) % len(weights) + 1
    )
    weighed = by_source.withColumn("place", place).withColumn("weight", weight.cast("bigint"))
    cap = F.col("source_size") * repeats
    by_limit = Window.orderBy((cap / F.col("weight")), "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    zero = F.lit(0).cast("bigint")
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), zero)
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), zero)
    level = weighed.withColumn("level", left / open_weight)
    free = level.withColumn("free", cap / F.col("weight") >= F.col("level"))
    first = F.min(F.when(F.col("free"), F.struct(cap / F.col("weight"), "place", "level"))).over(every)
    return free.withColumn("water", first["level"]).select(
        "source",
        "place",
        "weight",
        "source_size",
        F.when(F.col("free"), F.col("water") * F.col("weight")).otherwise(cap.cast("double")).alias("target"),
    )


def _rows(docs: DataFrame, key: str, source: str, size: Column | None, seed: int, keep: list[Column]) -> DataFrame:
    """rid, doc_id, source, size and turn of every row, with ``keep``, written once."""
    size = word_count() if size is None else size
    label = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    named = docs.select(*keep, F.col(key).alias("doc_id"), F.col(source).alias("source"), size.alias("size"))
    return numbered(named.withColumn("turn", F.md5(label)), "mix_rows")


def _cut(copies: DataFrame, budget: int) -> tuple[DataFrame, int, int]:
    """The slice of copies in which the budget ends, its number, and what is left for it.

    At most 8,193 sums reach the driver, whatever the data.
    """
    used, cut = 0, 2 * SLICES + 1
    for number, n in sorted(tuple(r) for r in copies.groupBy("slice").agg(F.sum("size")).collect()):
        if used + n > budget:
            cut = number
            break
        used += n
    return copies.filter(F.col("slice") == cut), cut, budget - used


def _plan(rows: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """The plan of written rows of rid, doc_id, source, size and turn."""
    rows = rows.select("rid", "doc_id", "source", "size", "turn")
    sources = save_step(targets(rows.select("source", "size"), weights, repeats), "mix_sources")
    budget = rows.agg(F.sum("size")).first()[0] or 0

    bucket = F.substring("turn", 1, 3)  # 4,096 buckets
    sums = (
        rows.groupBy("source", bucket.alias("bucket"))
        .agg(F.sum("size").alias("n"))
        .withColumn("done", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n"))
        .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "done")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("turn", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0
    )
    timed = (
        rows.withColumn("bucket", bucket)
        .withColumn("ends", F.sum("size").over(inside))
        .join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .drop("s", "b")
        .withColumn("ends", F.col("ends") + F.col("done"))
        .join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select("rid", "place", "turn", "doc_id", "size", "ends", "source_size", "target")
    )
    timed = save_step(timed, "mix_times")
    target = F.nullif(F.col("target"), F.lit(0.0))
    slot = F.least(F.floor(F.col("time") * SLICES), F.lit(2 * SLICES))
    copies = (
        timed.filter("size > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("time", (F.col("ends") + F.col("copy") * F.col("source_size")) / target)
        .withColumn("slice", slot)
    )
    open_slice, cut, left = _cut(copies, budget)
    # The slice in which the budget ends is cut again; only one part of it is sorted.
    finer = F.least(F.floor((F.col("time") * SLICES - cut) * SLICES), F.lit(2 * SLICES))
    open_slice = save_step(open_slice.withColumn("slice", finer), "mix_open")
    part, fine_cut, left = _cut(open_slice, left)
    last = Window.orderBy("time", "place", "copy", "turn").rowsBetween(Window.unboundedPreceding, 0)
    taken = (
        part.withColumn("sum", F.sum("size").over(last))
        .filter(F.col("sum") <= left)
        .drop("sum")
        .unionAll(open_slice.filter(F.col("slice") < fine_cut))
    )
    extra = taken.groupBy(F.col("rid").alias("r")).agg(F.count("*").alias("extra"))
    times = [(F.col("ends") + F.lit(i) * F.col("source_size")) / target for i in range(repeats)]
    sure = sum(
        (F.when(F.least(F.floor(t * SLICES), F.lit(2 * SLICES)) < cut, 1).otherwise(0) for t in times), F.lit(0)
    )
    return (
        timed.join(extra, F.col("rid") == F.col("r"), "left")
        .withColumn("copies", F.when(F.col("size") > 0, sure + F.coalesce("extra", F.lit(0))).otherwise(0))
        .select(
            "rid",
            "doc_id",
            "size",
            "source_size",
            "target",
            F.col("copies").cast("int").alias("copies"),
            (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
            F.when(F.col("size") > 0, times[0]).alias("first_time"),
            F.when(F.col("size") > 0, F.col("source_size") / target).alias("lap"),
        )
    )


def mix_plan(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """The part of every row of ``docs`` in the mix.

    Columns: doc_id, size, source_size, target, copies, taken, first_time (virtual finish
    time of its first copy) and lap (time between copies). A null text has size 0 and is
    never taken, like any row of size 0. Rows that repeat are rows of their own. The
    result depends on keys, sources and sizes only; rows with the same key, source and
    size are alike, and either may be the one that is taken.
    """
    return _plan(_rows(docs, key, source, size, seed, []), weights, repeats).drop("rid")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: whole rows of ``docs``, repeated as taken, sorted by finish time.

    The plan is made on numbers alone. Whole rows move twice: to their number of
    copies, and to their place.
    """
    rows = _rows(docs, key, source, size, seed, [F.struct("*").alias("row")])
    plan = _plan(rows, weights, repeats).filter("copies > 0").select("rid", "copies", "first_time", "lap")
    whole = rows.select("rid", "row").join(save_step(plan, "mix_plan"), "rid")
    copied = whole.withColumn("copy", F.explode(F.expr("sequence(0, copies - 1)")))
    time = (F.col("first_time") + F.col("copy") * F.col("lap")).alias("time")
    return copied.select("row", time).orderBy("time").select("row.*")
