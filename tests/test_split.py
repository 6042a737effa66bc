import json

import pytest
from pyspark.sql import functions as F

from turnmill.operators import positions, split


def members(df, key="pos"):
    out = {"train": set(), "test": set()}
    for r in df.collect():
        out[r.split].add(r[key])
    return out


@pytest.mark.parametrize("shuffle", [True, False])
@pytest.mark.parametrize("n,ratio", [(100, 0.29), (1, 0.8), (20_011, 0.8), (7, 1.0), (5, 0.0)])
def test_sizes_are_exact(spark, n, ratio, shuffle):
    df = spark.range(n).select((F.col("id") * 3).alias("pos"))
    got = members(split.train_test_split(df, train_ratio=ratio, shuffle=shuffle))
    assert len(got["train"]) == int(n * ratio)
    assert len(got["train"]) + len(got["test"]) == n
    if not shuffle:
        assert got["train"] == {3 * i for i in range(int(n * ratio))}


def test_same_seed_same_split_whatever_the_layout(spark):
    df = spark.range(5000).withColumnRenamed("id", "pos")
    first = members(split.train_test_split(df.repartition(1)))
    again = members(split.train_test_split(df.repartition(37)))
    other = members(split.train_test_split(df, seed=7))
    assert first == again != other


def test_ordered_cut_with_wide_gaps(spark):
    df = spark.createDataFrame([(v,) for v in [-9, 0, 5, 1 << 40, (1 << 62) + 1]], "pos BIGINT")
    got = members(split.train_test_split(df, train_ratio=0.8, shuffle=False))
    assert got["test"] == {(1 << 62) + 1}


def test_subsample_of_test(spark):
    df = spark.range(100).withColumnRenamed("id", "pos")
    parts = split.train_test_split(df, shuffle=False)
    got = members(split.subsample_test(parts, shuffle=False))
    assert got["test"] == set(range(80, 88)) and len(got["train"]) == 80
    small = split.train_test_split(spark.range(11).withColumnRenamed("id", "pos"))
    sizes = members(split.subsample_test(small))
    assert len(sizes["train"]) == 8 and len(sizes["test"]) == 0


def test_stratified_quotas(spark):
    rows = [(i, "A" if i < 11 else "B" if i < 17 else "C") for i in range(20)]
    df = spark.createDataFrame(rows, "pos BIGINT, category STRING")
    got = split.stratified_split(df).groupBy("category", "split").count().collect()
    counts = {(r.category, r.split): r["count"] for r in got}
    assert counts == {
        ("A", "train"): 9, ("B", "train"): 5, ("C", "train"): 2,
        ("A", "test"): 2, ("B", "test"): 1, ("C", "test"): 1,
    }


def test_stratified_missing_labels_and_hot_label(spark):
    label = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "other")
    df = spark.range(3000).select(F.col("id").alias("pos"), label.alias("category"))
    got = split.stratified_split(df).groupBy("category", "split").count().collect()
    assert {(r.category, r.split): r["count"] for r in got} == {
        (c, s): n for c in ("hot", "other", None) for s, n in (("train", 800), ("test", 200))
    }


def test_stratified_errors(spark):
    one = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b")], "pos BIGINT, category STRING")
    with pytest.raises(ValueError):
        split.stratified_split(one)
    two = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(4)], "pos BIGINT, category STRING")
    with pytest.raises(ValueError):
        split.stratified_split(two)  # one test row for two labels
    with pytest.raises(ValueError):
        split.stratified_split(two, shuffle=False)
    assert members(split.stratified_split(two.drop("category")))  # plain split instead


def test_statistics(spark, samples):
    empty = split.split_statistics(spark.createDataFrame([], "split STRING")).first()
    assert (empty.total_samples, empty.train_ratio) == (0, None)
    texts = ['{"a":1,"b":2}', '{"b":null}', '{"a":1}', '{"c":1}']
    parts = split.train_test_split(samples(texts), train_ratio=0.5, shuffle=False)
    fields = {r.field: r.presence for r in split.field_statistics(parts).collect()}
    assert fields == {"a": "common", "b": "train_only", "c": "test_only"}
    first = split.field_statistics(parts, first_row_only=True).collect()
    assert {r.field: r.presence for r in first} == {"a": "common", "b": "train_only"}


def test_positions_and_batches(spark):
    frames = [spark.range(5, numPartitions=3), spark.range(100, 107, numPartitions=2)]
    rows = positions.with_positions(frames).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(12))
    assert [r.id for r in rows] == [*range(5), *range(100, 107)]
    df = spark.range(40).select((F.col("id") * 1000 - 7).alias("pos")).repartition(7)
    got = positions.batch_numbers(df).orderBy("pos").collect()
    assert [r.batch for r in got] == [i // 16 + 1 for i in range(40)]


def test_saved_split_keeps_every_row(spark, samples, tmp_path):
    from turnmill.sources.writers import save_split

    parts = split.train_test_split(samples([json.dumps({"i": i}) for i in range(10)]))
    for fmt, reader in (("jsonl", spark.read.json), ("csv", None)):
        path = str(tmp_path / fmt)
        save_split(parts, path, fmt)
        back = reader(path) if reader else spark.read.csv(path, header=True, escape='"')
        assert members(back) == {
            s: {type(next(iter(v)))(x) for x in v} for s, v in members(back).items()
        }
        assert back.filter("split = 'train'").count() == 8
    with pytest.raises(ValueError):
        save_split(parts, str(tmp_path / "x"), "xml")


def test_keys_at_the_ends_of_the_range(spark):
    keys = [-(2**62) - 1, -(2**62), -5, 0, 7, 2**62, 2**62 + 9, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(k,) for k in keys], "id BIGINT")
    rows = split.train_test_split(df, "id", 0.5, shuffle=False).collect()
    assert sorted(r["id"] for r in rows if r["split"] == "train") == sorted(keys)[:4]
    ranks = {r["id"]: r["rank"] for r in positions.with_rank(df, "id").collect()}
    assert [ranks[k] for k in sorted(keys)] == list(range(len(keys)))


def test_ranks_use_many_tasks_beside_an_outlier(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 0, 1 << 62).otherwise(F.col("id")).alias("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = positions.with_rank(df, "id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranked.filter("id < 20000 AND rank <> id - 1").count() == 0
    assert ranked.filter(f"id = {1 << 62}").first()["rank"] == 19_999
    # One file per task that sorted a range.
    shares = [spark.read.parquet(f).count() for f in set(ranked.inputFiles())]
    assert len(shares) >= 4 and max(shares) < 15_000


def test_a_label_per_two_rows_splits(spark):
    df = spark.range(400).select(F.col("id").alias("pos"), F.expr("id DIV 2").alias("category"))
    rows = split.stratified_split(df, test_ratio=0.5, train_ratio=0.5).groupBy("category")
    sides = rows.agg(F.count_distinct("split").alias("n")).filter("n = 2").count()
    assert sides == 200
