"""Repeated passages: every span stands in its source, planted ones are found, mosaics stay."""

import random

import pytest
from conftest import SF

from turnmill.llm import substring_dedup

DDL = "doc_id BIGINT, text STRING"


def spans(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, DDL).repartition(parts)
    found = [tuple(r) for r in substring_dedup.repeated_passages(docs).collect()]
    texts = {d: (t or "").encode() for d, t in rows}
    ends = {}
    for doc, start, size, source in sorted(found):
        part = texts[doc][start : start + size]
        assert len(part) == size and part.decode()
        at = texts[source].find(part)
        assert at >= 0 and (source < doc or source == doc and at < start)
        assert start >= ends.get(doc, 0)  # spans of a row do not overlap
        ends[doc] = start + size
    return sorted(found)


def prose(rng, n):
    return " ".join("".join(rng.choice("aeinrstéß") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_planted_passages(spark):
    rng = random.Random(2)
    passages = [prose(rng, 55) for _ in range(30)]
    rows, planted = [], []
    for i in range(90):
        text, own = prose(rng, 40), []
        for k in rng.sample(range(30), 3):
            own.append((len((text + " ").encode()), k))
            text += " " + passages[k] + " " + prose(rng, rng.randint(1, 60))
        rows.append((i, text))
        planted.append(own)
    found = spans(spark, rows)
    covered = total = clean = 0
    seen = set()
    for i, own in enumerate(planted):
        gone = {b for d, start, size, _ in found if d == i for b in range(start, start + size)}
        again = set()
        for start, k in own:
            place = range(start, start + len(passages[k].encode()))
            if k in seen:
                covered, total = covered + len(gone & set(place)), total + len(place)
                again |= {b for b in range(place.start - 20, place.stop + 20)}
            seen.add(k)
        clean += len(gone - again)
    assert covered > 0.97 * total and clean == 0


def test_a_mosaic_of_short_pieces_stays(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, 300)) for i in range(60)]
    pieces = []
    for i in range(40):
        at = rng.randrange(len(rows[i][1]) - 50)
        pieces.append(rows[i][1][at : at + rng.randint(20, 45)])
    assert spans(spark, [*rows, (99, "".join(pieces))]) == []


def test_order_follows_the_key(spark):
    rng = random.Random(7)
    text = prose(rng, 80)
    rows = [(5, "x " + text), (3, text), (9, text + " y"), (4, None), (6, "")]
    want = spans(spark, rows, 1)
    assert {(d, s) for d, _, _, s in want} == {(5, 3), (9, 3)}
    assert spans(spark, rows[::-1], 1) == want == spans(spark, rows, 5)


def test_repeats_inside_a_text_and_long_ones(spark):
    rng = random.Random(8)
    part = prose(rng, 60)
    rows = [(1, f"{part} and {part}"), (2, "日本語の文章" * 300), (3, "ab" * 5000)]
    found = spans(spark, rows)
    first = next(r for r in found if r[0] == 1)
    assert first[1] >= len(part.encode()) and first[2] >= len(part.encode())
    docs = spark.createDataFrame(rows, DDL)
    kept = {r["doc_id"]: (r["removed_bytes"], r["text"]) for r in substring_dedup.drop_passages(docs).collect()}
    for doc, text in rows:
        data, at, left = text.encode(), 0, b""
        for _, start, size, _ in [r for r in found if r[0] == doc]:
            left, at = left + data[at:start], start + size
        assert kept[doc] == (sum(r[2] for r in found if r[0] == doc), (left + data[at:]).decode())


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert spans(spark, rows)


def test_equal_digests_of_other_bytes(spark, monkeypatch):
    """Only bytes that were compared are removed, whatever the digests say."""
    rng = random.Random(3)
    rows = [(i, prose(rng, 100)) for i in range(4)]
    a, b = (x.encode() for _, x in rows[:2])
    import pyarrow as pa

    columns = [[1], [0], [0], [0], [200], [a[:400]], [b[:400]]]
    kinds = [pa.int64()] * 5 + [pa.binary()] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list("abcdefg"))
    assert [x.num_rows for x in substring_dedup._extend(iter([batch]))] == [0]


@pytest.mark.parametrize("text", ["é", "日", "a", "😀"])
def test_whole_characters(text):
    import numpy as np

    data = np.frombuffer(("x" + text).encode(), np.uint8)
    assert substring_dedup._whole(data)
    assert len(text.encode()) == 1 or not substring_dedup._whole(data[:-1])


def test_texts_are_shuffled_once(spark):
    """A text is cut for its own matches and for those that have it as their source: from one shuffle."""
    rng = random.Random(11)
    shared = prose(rng, 80)
    rows = [(i, i, f"{prose(rng, 40)} {shared} {prose(rng, 40)}") for i in range(40)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = substring_dedup.repeated_spans(spark.createDataFrame(rows, "rid BIGINT, doc_id BIGINT, text STRING"))
        spans = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.rid, r.source) for r in spans} == {(i, 0) for i in range(1, 40)}
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
