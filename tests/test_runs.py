import json
import os

from conftest import SF
from pyspark.sql import functions as F

from turnmill.operators.formats import to_format, with_original
from turnmill.plans import adapters, build
from turnmill.streaming import resume


def test_whole_run_writes_the_bundle(spark, tmp_path):
    samples = adapters.conversation_pairs(spark, SF).select("sample_id").distinct()
    attempts = adapters.conversation_attempts(spark, SF)
    out = str(tmp_path / "out")
    summary = build.run(samples, attempts, out).first()
    n = samples.count()
    assert summary.total_train_samples == int(n * 0.8)
    assert summary.total_test_samples == min(n - int(n * 0.8), int(n * 0.8) // 10)
    assert summary.successful_train_samples == summary.kept_train_samples
    assert sum(c.request_count for c in summary.clients) == attempts.count()
    files = summary.output_files
    assert set(files) == {"train", "test", "metadata", "alpaca_train", "sharegpt_train"}
    records = spark.read.json(files["train"])
    assert records.count() == summary.kept_train_samples
    alpaca = spark.read.json(files["alpaca_train"])
    assert alpaca.count() == records.count()
    assert set(alpaca.columns) == {"instruction", "input", "output"}
    chats = spark.read.json(files["sharegpt_train"])
    assert chats.select(F.explode("conversations")).count() == 2 * (
        records.select(F.explode("conversations")).count()
    )
    written = json.loads(spark.read.text(f"{out}/pipeline_summary.json").first()[0])
    assert written["total_train_samples"] == summary.total_train_samples


def test_bundle_carries_the_sample_as_given(spark, tmp_path):
    given = [
        {"question": f"why {i}?", "answer": f"since {i} is\nso", "_source": "a.jsonl", "b": {"z": 1, "a": [i]}}
        for i in range(40)
    ]
    rows = [
        (i, json.dumps(x, ensure_ascii=False, indent=1 if i % 2 else None), "asked", "a.jsonl")
        for i, x in enumerate(given)
    ]
    samples = spark.createDataFrame(rows, "sample_id BIGINT, sample STRING, prompt STRING, _source STRING")
    said = F.concat(F.lit("answer "), F.md5(F.col("sample_id").cast("string")))
    attempts = samples.select(
        "sample_id", F.lit(1).alias("round"), F.lit("openai").alias("client"),
        F.lit(1).alias("attempt_no"), "prompt", said.alias("response"),
        F.lit(None).cast("string").alias("error"), F.lit(2.0).alias("ts"),
    )
    out = str(tmp_path / "out")
    shared = spark.conf.get("spark.checkpoint.dir") + "/turnmill"
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    summary = build.run(samples, attempts, out, threshold=0.99).first()
    assert set(os.listdir(shared)) == before
    files = summary.output_files
    lines = [json.loads(r[0]) for r in spark.read.text([files["train"], files["test"]]).collect()]
    assert len(lines) == summary.kept_train_samples + summary.kept_test_samples == 32 + 3
    for line in lines:
        assert list(line) == ["conversations", "original_data", "generation_metadata"]
        i = line["original_data"]["b"]["a"][0]
        assert line["original_data"] == given[i] and list(line["original_data"]) == list(given[i])
        assert set(line["conversations"][0]) == {"instruction", "output", "input", "metadata"}
        assert line["generation_metadata"]["num_turns"] == 1
    metadata = json.loads(spark.read.text(files["metadata"]).first()[0])
    assert metadata["successful_test_samples"] == 3 and metadata["timestamp"] >= summary.start_time
    assert metadata["generation_config"]["similarity_threshold"] == "0.99"
    assert summary.total_execution_time == summary.end_time - summary.start_time > 0
    # Without turns, the question and answer of the original data are exported.
    bare = spark.read.text(files["train"]).select(
        F.regexp_replace("value", r"^\{\"conversations\":\[.*?\],\"orig", '{"conversations":[],"orig').alias("sample")
    )
    pairs = {(r.instruction, r.output) for r in to_format(bare, "alpaca", sample="sample").collect()}
    assert len(pairs) == 32 and pairs <= {(x["question"], x["answer"]) for x in given}


def test_original_data_of_typed_samples(spark):
    typed = spark.createDataFrame([(1, "x", None)], "sample_id BIGINT, text STRING, prompt STRING")
    made = with_original(typed)
    assert made.columns == ["sample_id", "text", "original_data"]
    assert json.loads(made.first().original_data) == {"sample_id": 1, "text": "x"}
    kept = with_original(typed.withColumn("original_data", F.lit('{"a":1}')))
    assert kept.first().original_data == '{"a":1}'


def test_near_duplicates_go_per_split_in_split_order(spark):
    samples = adapters.conversation_pairs(spark, SF).select("sample_id").distinct()
    one = adapters.conversation_attempts(spark, SF)
    first = one.groupBy("round").agg(F.min_by("response", "sample_id").alias("same"))
    copied = one.join(first, "round").withColumn("response", F.col("same")).drop("same")
    copied = copied.withColumn("prompt", F.lit("please go on"))
    copied = copied.filter("round = 1")
    full = build.build_records(samples, copied, filter_duplicates=False)
    kept = build.build_records(samples, copied)
    assert full.groupBy("split").count().count() == kept.count() == 2
    key = F.md5(F.concat_ws(":", F.lit("42"), F.col("sample_id").cast("string")))
    want = full.groupBy("split").agg(F.min_by("sample_id", key)).collect()
    assert {tuple(r) for r in want} == {(r.split, r.sample_id) for r in kept.collect()}


def test_ledger(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    samples = spark.range(5).withColumnRenamed("id", "sample_id")
    assert resume.pending(samples, resume.read_ledger(spark, ledger)).count() == 5
    done = samples.filter("sample_id < 3").withColumn("success", F.lit(True))
    resume.record(done, out, ledger)
    left = resume.pending(samples, resume.read_ledger(spark, ledger))
    assert {r.sample_id for r in left.collect()} == {3, 4}
    resume.record(left.withColumn("success", F.lit(False)), out, ledger)
    resume.record(done, out, ledger)  # a repeated part
    assert resume.pending(samples, resume.read_ledger(spark, ledger)).count() == 0
    assert sorted(r.sample_id for r in resume.finished(spark, out).collect()) == [0, 1, 2, 3, 4]
    resume.record(samples.filter("sample_id = 0").withColumn("success", F.lit(False)), out, ledger)
    last = {r.sample_id: r.success for r in resume.finished(spark, out).collect()}
    assert last == {0: False, 1: True, 2: True, 3: False, 4: False}


def test_ledger_after_a_crash_between_the_two_writes(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    samples = spark.range(6).withColumnRenamed("id", "sample_id")
    done = samples.withColumn("success", F.lit(True))
    resume.record(done.filter("sample_id < 2"), out, ledger)
    # A run that was committed but not entered, and one that died while it wrote.
    done.filter("sample_id = 2").write.parquet(f"{out}/run=1")
    done.filter("sample_id = 5").write.parquet(f"{out}/run=2")
    os.remove(f"{out}/run=2/_SUCCESS")
    for n in ("00000001", "00000002"):
        open(f"{out}/_claims/{n}", "w").close()
    assert resume.pending(samples, resume.read_ledger(spark, ledger)).count() == 4
    first = sorted(os.listdir(f"{ledger}/p00000000"))
    resume.record(done.filter("sample_id = 3"), out, ledger)
    assert sorted(os.listdir(f"{ledger}/p00000000")) == first
    left = resume.pending(samples, resume.read_ledger(spark, ledger))
    assert {r.sample_id for r in left.collect()} == {4, 5}
    assert sorted(r.sample_id for r in resume.finished(spark, out).collect()) == [0, 1, 2, 3]
    assert resume.repair(spark, out, ledger) == []


def test_ledger_compaction(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    rows = spark.range(4).withColumnRenamed("id", "sample_id")
    assert resume.compact(spark, out, ledger) is None
    for ok in (False, True):
        resume.record(rows.withColumn("success", F.lit(ok)), out, ledger)
    old = resume.read_ledger(spark, ledger)
    assert resume.compact(spark, out, ledger) == "c00000001"
    assert old.count() == 8  # a reader of the older snapshot
    assert {tuple(r) for r in resume.read_ledger(spark, ledger).collect()} == {(i, True) for i in range(4)}
    resume.record(spark.range(4, 6).selectExpr("id AS sample_id", "true AS success"), out, ledger)
    assert resume.ledger_parts(spark, ledger) == ["c00000001", "p00000002"]
    assert resume.read_ledger(spark, ledger).count() == 6
    assert resume.repair(spark, out, ledger) == []


def test_runs_claim_numbers_of_their_own(spark, tmp_path):
    out = str(tmp_path / "out")
    assert [resume.claim(spark, out) for _ in range(3)] == [0, 1, 2]
    os.remove(f"{out}/_claims/00000001")
    assert resume.claim(spark, out) == 3


def test_new_files_only(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def work(batch):
        return batch.withColumn("length", F.length("sample"))

    for name in ("a", "b"):
        (source / f"{name}.jsonl").write_text(f'{{"id":"{name}"}}\n\n', encoding="utf-8")
        resume.run_new_files(spark, str(source), work, out, checkpoint)
    rows = spark.read.parquet(out).collect()
    assert sorted(json.loads(r.sample)["id"] for r in rows) == ["a", "b"]
    assert {r.batch for r in rows} == {0, 1}
