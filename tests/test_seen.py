"""Exact duplicates against earlier runs."""

import pytest
from pyspark.sql import functions as F

from turnmill.streaming import seen
from turnmill.streaming.resume import ledger_parts


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "kept"), str(tmp_path / "index")


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id BIGINT, text STRING")


def kept(spark, out):
    return sorted((r.run, r.doc_id) for r in seen.kept_rows(spark, out).collect())


def test_increments_keep_each_text_once(spark, places):
    out, index = places
    seen.record_new(rows(spark, [(5, "a"), (3, "a"), (7, None), (8, None), (9, "")]), out, index)
    seen.record_new(rows(spark, [(1, "a"), (2, "b"), (4, None), (6, "")]), out, index)
    seen.record_new(rows(spark, []), out, index)
    seen.record_new(rows(spark, [(10, "c"), (11, "b"), (12, "c")]), out, index)
    assert kept(spark, out) == [(0, 3), (0, 7), (0, 9), (1, 2), (3, 10)]


def test_many_texts_of_runs_of_different_size(spark, places):
    out, index = places
    sizes = [4000, 30, 1500]
    for run, n in enumerate(sizes):
        made = spark.range(n).select(
            (F.col("id") + run * 10_000).alias("doc_id"),
            F.concat(F.lit("text "), (F.col("id") * (run + 1)).cast("string")).alias("text"),
        )
        seen.record_new(made, out, index)
    known, want = set(), []
    for run, n in enumerate(sizes):
        for i in range(n):
            text = i * (run + 1)
            if text not in known:
                known.add(text)
                want.append((run, i + run * 10_000))
    assert kept(spark, out) == want
    depths = spark.read.parquet(f"{index}/filters/p00000000").select("depth").distinct().collect()
    assert [r.depth for r in depths] == [4]


def test_filters_know_every_text_and_few_others(spark):
    def hashes(start, end):
        return spark.range(start, end).select(F.md5(F.col("id").cast("string")).alias("hash"))

    filters = seen.range_filters(hashes(0, 20_000), 20_000)
    assert filters.filter(F.size("bits") != seen.WORDS).isEmpty()
    assert seen.may_be_seen(hashes(0, 20_000), filters).count() == 20_000
    assert seen.may_be_seen(hashes(20_000, 60_000), filters).count() < 0.02 * 40_000


def test_runs_that_died_are_entered_by_the_next(spark, places):
    out, index = places
    assert [seen.claim(spark, out) for _ in range(2)] == [0, 1]
    # Results without keys, then keys without filters.
    rows(spark, [(1, "a")]).write.parquet(f"{out}/run=0")
    rows(spark, [(2, "b")]).write.parquet(f"{out}/run=1")
    hashed = rows(spark, [(2, "b")]).select(F.md5("text").alias("hash"), F.col("doc_id").alias("key"))
    hashed.write.parquet(f"{index}/keys/p00000001")
    seen.record_new(rows(spark, [(3, "b"), (4, "a"), (5, "c")]), out, index)
    assert kept(spark, out) == [(0, 1), (1, 2), (2, 5)]


def test_results_that_were_not_committed_are_in_no_snapshot(spark, places):
    out, index = places
    seen.record_new(rows(spark, [(1, "a")]), out, index)
    run = seen.claim(spark, out)
    rows(spark, [(2, "b")]).write.parquet(f"{out}/run={run}")
    (spark._jvm.org.apache.hadoop.fs.Path(f"{out}/run={run}/_SUCCESS")).getFileSystem(
        spark._jsc.hadoopConfiguration()
    ).delete(spark._jvm.org.apache.hadoop.fs.Path(f"{out}/run={run}/_SUCCESS"), False)
    seen.record_new(rows(spark, [(3, "b"), (4, "a")]), out, index)
    assert kept(spark, out) == [(0, 1), (2, 3)]


def test_compacted_index_gives_the_same_rows(spark, places):
    out, index = places
    seen.record_new(rows(spark, [(i, f"t{i}") for i in range(300)]), out, index)
    seen.record_new(rows(spark, [(i, f"t{i}") for i in range(200, 700)]), out, index)
    assert seen.compact_index(spark, out, index) == "c00000001"
    assert ledger_parts(spark, f"{index}/keys") == ["c00000001"]
    assert seen.compact_index(spark, out, index) is None
    seen.record_new(rows(spark, [(i, f"t{i}") for i in range(650, 710)]), out, index)
    assert [x for x in kept(spark, out) if x[0] == 2] == [(2, i) for i in range(700, 710)]
