import re
from collections import Counter

import corpus_pipeline
from conftest import SF
from turnmill.session import save_step


def test_stages_equal_plain_python(spark):
    """Every stage against a brute-force version over its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    inputs = []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = save_step(stage(spark, docs, SF), name.replace(" ", "_"))
        if name != "packing":
            assert docs.columns == inputs[0].columns
    source, named, exact, near, mixed = ({r["doc_id"]: r for r in d.collect()} for d in inputs)
    assert named.keys() == {i for i, r in source.items() if any(c.isalpha() for c in r["text"] or "")}

    groups = {}
    for r in named.values():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"]), []).append(r)
    assert exact.keys() == {min(g, key=lambda r: (-len(r["text"]), r["doc_id"]))["doc_id"] for g in groups.values()}

    sets = {}
    for i, r in exact.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    assert near.keys() == {i for i, x in label.items() if i == x}

    rows = inputs[4].collect()
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for i, r in near.items()}
    assert max(Counter(r["doc_id"] for r in rows).values()) <= 3
    sizes, taken = Counter(), Counter()
    for r in near.values():
        sizes[r["source"]] += words[r["doc_id"]]
    for r in rows:
        taken[r["source"]] += words[r["doc_id"]]
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))}
    target, open_sources = {}, set(sizes)
    while True:
        rest = sum(sizes.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_sources) for s in open_sources}
        over = [s for s in open_sources if share[s] > 3 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * sizes[s]
            open_sources.discard(s)
    longest = max(words.values())
    assert all(abs(taken[s] - target[s]) <= longest for s in sizes)
    assert sum(taken.values()) <= sum(sizes.values())

    packed = Counter()
    for r in docs.collect():
        packed[r["doc_id"]] += r["length"]
        assert len(r["ids"]) == 4 * r["length"]
    assert packed.keys() == {r["doc_id"] for r in rows}


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns[0] == "doc_id"


def test_stages_delete_earlier_steps(spark):
    """Every stage deletes the steps of the one before; ``clean`` those that are left."""
    from pathlib import Path

    from turnmill.session import shared_dir

    def folders():
        return set((Path(shared_dir(spark).removeprefix("file://")) / "turnmill").glob("*"))

    corpus_pipeline.clean(spark)
    before = folders()
    assert corpus_pipeline.run(spark, SF).count()
    assert len(folders() - before) == 3  # the mixed documents, the pieces, the first numbers of sequences
    corpus_pipeline.clean(spark)
    assert folders() == before


def test_steps_that_documents_read_stay(spark):
    """A stage whose documents were not written yet can still compute them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lazy = corpus_pipeline.drop_exact_copies(spark, docs, SF)
    n = lazy.count()
    assert corpus_pipeline.drop_near_copies(spark, lazy, SF).count() <= n == lazy.count()


def test_stages_read_whole_texts_in_short_batches(spark):
    docs = spark.createDataFrame([(1, "one text", "en")], "doc_id BIGINT, text STRING, lang STRING")
    before = {batch: spark.conf.get(batch) for batch in ["spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch"]}
    try:
        for given, most in (("4096", 1000), ("7", 7)):
            for batch in before:
                spark.conf.set(batch, given)
            assert corpus_pipeline.drop_exact_copies(spark, docs, "").count() == 1
            assert all(0 < int(spark.conf.get(batch)) <= most for batch in before)
    finally:
        for batch, rows in before.items():
            spark.conf.set(batch, rows)
    assert corpus_pipeline.BATCHES["spark.sql.parquet.columnarReaderBatchSize"] < 4096
