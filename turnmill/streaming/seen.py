"""Exact duplicates against everything that earlier runs kept.

Every run's kept rows are a folder of their own. Its text hashes are entered in an index of
two tables, a part per run: ``keys`` (hash and key, in hash order) and ``filters``, Bloom
filters over ranges of the hash. A new run meets the filters, which take about two bytes a
text; only the texts that pass one are looked up among the keys, so a false hit costs a
lookup and decides nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions.text import content_hash
from turnmill.session import save_step
from turnmill.streaming.resume import claim, committed_runs, ledger_parts

#: A filter covers a range of hashes in so many words of 64 bits, four keys a word.
WORDS = 64
KEYS_PER_WORD = 4
#: The range of a hash is read from its first so many bits.
RANGE_BITS = 60
#: Stands for the hash of a NULL text: all NULLs are one text.
NULL_HASH = "0" * 32

KEYS, FILTERS = "keys", "filters"


def _hash(text: str) -> Column:
    return F.coalesce(content_hash(F.col(text)), F.lit(NULL_HASH)).alias("hash")


def _hex(place: int, digits: int) -> Column:
    return F.conv(F.substring("hash", place, digits), 16, 10).cast("bigint")


def _with_range(hashes: DataFrame, depth: Column) -> DataFrame:
    """The filter of every hash at a depth of so many leading bits, and its bits there.

    Word and bits come from digits that the range does not use.
    """
    digits = hashes.withColumn("depth", depth).withColumns({"_n": _hex(1, 15), "_m": _hex(17, 8)})
    bit = "shiftleft(1L, cast(shiftright(_m, {}) & 63 AS INT))"
    return digits.withColumns(
        {
            "range": F.expr(f"shiftright(_n, {RANGE_BITS} - depth)"),
            "word": F.expr(f"cast(shiftright(_m, 24) % {WORDS} AS INT)"),
            "mask": F.expr(" | ".join(bit.format(shift) for shift in (0, 6, 12, 18))),
        }
    ).drop("_n", "_m")


def _depth(keys: int) -> int:
    """Leading bits that leave a filter its intended number of keys, or fewer."""
    return min((max(keys - 1, 0) // (WORDS * KEYS_PER_WORD)).bit_length(), RANGE_BITS)


def range_filters(keys: DataFrame, n: int) -> DataFrame:
    """Bloom filters of ``n`` distinct hashes, a row per range that has any."""
    placed = _with_range(keys.select("hash"), F.lit(_depth(n)))
    # Partitioned by range, both aggregates need no other shuffle.
    words = (
        placed.select("depth", "range", "word", "mask")
        .repartition("range")
        .groupBy("depth", "range", "word")
        .agg(F.bit_or("mask").alias("bits"))
    )
    by_word = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    every = F.sequence(F.lit(0), F.lit(WORDS - 1))
    return (
        words.groupBy("depth", "range")
        .agg(by_word.alias("_words"))
        .select(
            "depth",
            "range",
            F.transform(every, lambda w: F.coalesce(F.col("_words")[w], F.lit(0).cast("bigint"))).alias("bits"),
        )
    )


def _parts(spark: SparkSession, index: str, table: str) -> DataFrame | None:
    parts = ledger_parts(spark, f"{index}/{table}")
    return spark.read.parquet(*[f"{index}/{table}/{n}" for n in parts]) if parts else None


def may_be_seen(hashes: DataFrame, filters: DataFrame) -> DataFrame:
    """Hashes that some filter knows: all that were entered, and about one in a hundred others."""
    # One value for each size of a run, 61 at most.
    depths = sorted(row.depth for row in filters.select("depth").distinct().collect())
    if not depths:
        return hashes.select("hash").limit(0)
    asked = _with_range(hashes.select("hash"), F.explode(F.array(*[F.lit(d) for d in depths])))
    known = F.col("bits")[F.col("word")].bitwiseAND(F.col("mask")) == F.col("mask")
    return asked.join(filters, ["depth", "range"]).filter(known).select("hash").distinct()


def new_rows(rows: DataFrame, index: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The first row, by ``key``, of every text that no earlier run entered.

    Keys must be unique. NULL texts count as one text, the empty text as another.
    """
    spark = rows.sparkSession
    firsts = save_step(rows.groupBy(_hash(text)).agg(F.min(key).alias("key")), "hashes")
    keys, filters = _parts(spark, index, KEYS), _parts(spark, index, FILTERS)
    if keys is not None and filters is not None:
        seen = may_be_seen(firsts, filters).join(keys.select("hash"), "hash", "left_semi")
        firsts = firsts.join(seen, "hash", "left_anti")
    wanted = firsts.select(F.col("key").alias(key))
    return rows.join(wanted, key, "left_semi")


def _write_part(spark: SparkSession, index: str, name: str, keys: DataFrame) -> None:
    """Enter keys under a part's name, then their filters from the part's own files."""
    keys.repartitionByRange("hash").sortWithinPartitions("hash").write.mode("overwrite").parquet(
        f"{index}/{KEYS}/{name}"
    )
    _write_filters(spark, index, name)


def _write_filters(spark: SparkSession, index: str, name: str) -> None:
    written = spark.read.parquet(f"{index}/{KEYS}/{name}")
    filters = range_filters(written, written.count())  # counted from file footers
    filters.write.mode("overwrite").parquet(f"{index}/{FILTERS}/{name}")


def enter_runs(spark: SparkSession, out: str, index: str, text: str = "text", key: str = "doc_id") -> list[int]:
    """Enter the committed runs that the index does not know; returns their numbers.

    A run that died after its results is entered from its files, and a part that died
    before its filters gets them from its keys.
    """
    parts = ledger_parts(spark, f"{index}/{KEYS}")
    for name in set(parts).difference(ledger_parts(spark, f"{index}/{FILTERS}")):
        _write_filters(spark, index, name)
    since = next((int(n[1:]) for n in parts if n.startswith("c")), -1)
    known = {int(n[1:]) for n in parts}
    missing = [n for n in committed_runs(spark, out) if n > since and n not in known]
    for run in missing:
        kept = spark.read.parquet(f"{out}/run={run}")
        _write_part(spark, index, f"p{run:08d}", kept.select(_hash(text), F.col(key).alias("key")))
    return missing


def record_new(rows: DataFrame, out: str, index: str, text: str = "text", key: str = "doc_id") -> int:
    """Write the rows with new texts as a run of their own and enter them; returns its number.

    One writer at a time: two runs at once may keep the same text. A run that dies before
    its results are committed is in no snapshot, and its rows can be given again.
    """
    spark = rows.sparkSession
    enter_runs(spark, out, index, text, key)
    run = claim(spark, out)
    new_rows(rows, index, text, key).write.mode("overwrite").parquet(f"{out}/run={run}")
    enter_runs(spark, out, index, text, key)
    return run


def compact_index(spark: SparkSession, out: str, index: str, text: str = "text", key: str = "doc_id") -> str | None:
    """Join the parts of an index into one, with filters for its size; returns its name.

    Call it while no run is being recorded.
    """
    enter_runs(spark, out, index, text, key)
    parts = ledger_parts(spark, f"{index}/{KEYS}")
    if len(parts) < 2:
        return None
    name = f"c{int(parts[-1][1:]):08d}"
    _write_part(spark, index, name, _parts(spark, index, KEYS))
    return name


def kept_rows(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all committed runs, with the number of their run."""
    runs = committed_runs(spark, out)
    if not runs:
        raise ValueError(f"no results in {out}")
    return spark.read.option("basePath", out).parquet(*[f"{out}/run={n}" for n in runs])
