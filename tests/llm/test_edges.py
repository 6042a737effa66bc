"""Every dealt operator on nulls, empty and long texts, repeats, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from turnmill.llm import (
    exact,
    fingerprints,
    jaccard,
    language,
    line_dedup,
    mixing,
    packing,
    substring_dedup,
    token_counts,
    warc,
)

LONG = " ".join(f"word{i % 977}x{i}" for i in range(20_000))
ROWS = [
    (1, "Hello there my dear old friend", "en", "a", 30),
    (1, "Hello there my dear old friend", "en", "a", 30),  # a repeated row
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (None, " \t\n", "fr", "b", 3),
    (None, None, None, None, None),
    (4, "HELLO there my dear old friend", None, "c", 30),
    (5, LONG, "en", None, len(LONG)),
    (6, "été <|endoftext|> 123 !!! 　 日本", "fr", "a", 1),
    (7, "one\n\ntwo\nthree\none\ntwo\nthree", "en", "c", 1),
]
DDL = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Names that the operators use inside.
CLASH = ["rid", "key", "size", "target", "time", "row", "place", "label", "part", "id", "start", "page_id", "norm"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DDL).repartition(3).select("*", *[F.lit(c).alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def records(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact(docs, none):
    rows = exact.exact_groups(docs).collect()
    assert len(rows) == len(ROWS)
    empty = [r for r in rows if r["group_size"] == 4]
    assert len(empty) == 4 and {r["keep_id"] for r in empty} == {None}  # the blank text is longest
    assert [r["doc_id"] for r in empty if r["kept"]] == [None]
    assert sorted(r["doc_id"] for r in exact.drop_exact(docs).collect() if r["doc_id"]) == [1, 4, 5, 6, 7]
    assert exact.drop_exact(docs).columns == docs.columns
    assert exact.exact_groups(none).count() == 0 == exact.drop_exact(none).count()


def test_mixing(docs, none):
    rows = mixing.mix_plan(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in rows)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(none).count() == 0 == mixing.mix_plan(none).count()


def test_language(docs, none):
    model = language.fit(docs, F.lit(True))
    rows = language.predict(docs, model, [F.col("doc_id")]).collect()
    assert len(rows) == len(ROWS)
    named = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert named[2] == named[3] == named[None] == "und" and named[1] in model.languages
    untaught = language.fit(none, F.lit(True))
    assert {r["lang_pred"] for r in language.predict(docs, untaught, [F.col("doc_id")]).collect()} == {"und"}
    assert language.predict(none, model, [F.col("doc_id")]).count() == 0


def test_lines(docs, none):
    rows = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert rows[7]["text"] == "one\n\ntwo\nthree" and rows[7]["removed_lines"] == 3
    assert rows[2]["text"] is None and rows[2]["n_lines"] == 0 and rows[3]["n_lines"] == 1
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_passages(docs, none):
    twice = docs.unionAll(docs.filter("doc_id = 5"))
    found = substring_dedup.repeated_passages(twice).collect()
    assert [(r["doc_id"], r["start"], r["n_bytes"], r["first_doc_id"]) for r in found] == [(5, 0, len(LONG), 5)]
    texts = records(substring_dedup.drop_passages(twice).filter("doc_id = 5").select("text"))
    assert texts == [("",), (LONG,)]
    assert substring_dedup.repeated_passages(none).count() == 0 == substring_dedup.drop_passages(none).count()


def test_fingerprints(docs, none):
    rows = fingerprints.fingerprint_edits(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 1}) == 1
    assert fingerprints.fingerprint_edits(none).count() == 0
    one = fingerprints.fingerprint_edits(docs.filter("doc_id = 4")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_token_counts(docs, none):
    rows = token_counts.document_token_counts(docs)
    assert rows.count() == len(ROWS)
    assert {r["n_tokens"] for r in rows.filter("doc_id IN (2, 3)").collect()} == {0}
    assert token_counts.document_token_counts(none).count() == 0


def test_packing(docs, none):
    pieces = packing.pack(docs).collect()
    assert sum(r["length"] for r in pieces if r["doc_id"] == 2) == 1
    assert sorted(r["sequence_id"] for r in pieces) == list(range(len(pieces)))
    assert packing.pack(none).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, longest=1000)


def test_warc(docs, none):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), "rid")
    rows = warc.archive(pages).collect()
    assert len(rows) == len(ROWS)
    empty = {(r["page_id"], r["record_type"], r["refers_to"]) for r in rows if r["payload_bytes"] == 0}
    assert empty == {(2, "response", None), (3, "revisit", 2), (None, "revisit", 2)}
    assert [r["record_type"] for r in rows if r["page_id"] == 1] == ["response", "response"]
    assert warc.archive(pages.limit(0)).count() == 0


def test_jaccard(docs, none):
    rows = jaccard.similar_groups(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 4)} == {1}
    assert {(r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] in (2, 3)} == {(0, 2), (0, 3)}
    assert sorted(r["doc_id"] or 0 for r in jaccard.drop_similar(docs).collect()) == [0, 0, 1, 1, 2, 3, 5, 6, 7]
    assert jaccard.drop_similar(none).columns == docs.columns and jaccard.similar_groups(none).count() == 0


def test_clashing_names_of_joins(docs):
    rows = docs.select("*", F.lit(1).alias("gone"), F.lit(1).alias("k"), F.lit(1).alias("h"), F.lit(1).alias("copies"))
    assert sorted(r["doc_id"] or 0 for r in jaccard.drop_similar(rows).collect()) == [0, 0, 1, 1, 2, 3, 5, 6, 7]
    assert exact.drop_exact(rows).columns == rows.columns and exact.drop_exact(rows).count() == 6
    assert mixing.mix(rows).columns == rows.columns


def test_exact_keeps_one_of_rows_with_one_key(spark):
    same = [(1, "a b", "x"), (1, "a  b", "x"), (1, "ab", "x"), (2, "a  b", "x"), (None, "c", "x"), (None, "c", "x"), (3, "d", "y")]
    rows = spark.createDataFrame(same, "doc_id BIGINT, text STRING, source STRING")
    assert records(exact.drop_exact(rows)) == records(
        spark.createDataFrame([(1, "a  b", "x"), (None, "c", "x"), (3, "d", "y")], rows.schema)
    )


def test_mixing_ties(spark):
    """Equal sizes everywhere: finish times tie across sources, and the budget ends among ties."""
    rows = spark.createDataFrame([(i, "w " * 10, "abc"[i % 3], "x") for i in range(300)], "doc_id INT, text STRING, source STRING, row STRING")
    first, again = (records(mixing.mix_plan(r)) for r in (rows, rows.repartition(7)))
    assert first == again
    plan = mixing.mix_plan(rows).collect()
    assert 0 <= 3000 - sum(r["taken"] for r in plan) < 10
    mixed = [r["doc_id"] for r in mixing.mix(rows).collect()]
    assert len(mixed) == sum(r["copies"] for r in plan) == 300
