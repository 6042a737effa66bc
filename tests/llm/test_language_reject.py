"""The pipeline's language stage rejects by the parse, not only by letters."""

import corpus_pipeline
import numpy as np
from conftest import SF
from pyspark.sql import functions as F

from turnmill.llm import language

STRANGE = [
    "Съешь же ещё этих мягких французских булок, да выпей чаю",
    "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία",
    "色は匂へど散りぬるを我が世誰ぞ常ならむ",
]


def test_unlearned_scripts_go_and_learned_texts_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.orderBy("doc_id").first()["text"].split()
    more = [(-i, t, None) for i, t in enumerate([*STRANGE, first[0], " ".join(first[:5])], 1)]
    made = spark.createDataFrame(more, "doc_id BIGINT, text STRING, lang STRING").select(
        *[F.col(c) if c in ("doc_id", "text", "lang") else F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    )
    both = docs.unionByName(made)
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, both, SF).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in both.select("doc_id").collect()} - {-1, -2, -3}


def test_clean_texts_of_other_words_stay(spark):
    """Prose, upper case, tokens and notices unlike the sampled rows, but in learned scripts."""
    sf = SF.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert corpus_pipeline.identify_language(spark, docs, sf).count() == docs.filter(r"text RLIKE '\\p{L}'").count()


def test_levels_need_two_rows():
    sample = {"a": ["one text of words"], "b": ["ein text", "noch ein text"]}
    model = language.train(sample)
    found = language.levels(sample, model)
    assert np.isinf(found[0]) and np.isfinite(found[1])
    model.levels = found
    assert model.predict(["one text", "12"])[0] == ["a", language.UNKNOWN]
