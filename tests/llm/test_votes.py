"""Quality votes: brute force, held-out rows, and strange input."""

import zlib

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from turnmill.llm import quality_votes
from turnmill.llm.queries import QUERIES

SF_LARGER = SF.replace("sf0.001", "sf0.1")
DDL = "doc_id BIGINT, text STRING, lang STRING, label STRING, score STRING, key STRING, turn STRING"


def plain_counts(text):
    """Counts of the terms, byte by byte."""
    data, counts = text.encode(), np.zeros(quality_votes.TERMS, np.int64)
    for i in range(len(data) - 2):
        run = data[i] | data[i + 1] << 8 | data[i + 2] << 16
        counts[(run * 2654435761 % 2**32 >> 16) % (quality_votes.TERMS - 1) + 1] += 1
    words = data.split()
    counts[0] = sum(a == b for a, b in zip(words, words[1:]))
    return counts


def plain_votes(model, vectors):
    out = []
    for v in vectors:
        near = sorted(((round(float(np.float32(v @ u)), 6), y) for u, y in zip(model.vectors, model.labels)), reverse=True)
        least = near[min(len(near), quality_votes.NEIGHBOURS) - 1][0]
        votes = [(max(c, 0.0) ** quality_votes.SHARPNESS, y) for c, y in near if c >= least]
        total = sum(w for w, _ in votes)
        out.append(sum(w * y for w, y in votes) / total if total else model.labels.mean())
    return out


@pytest.mark.parametrize("size", [5, 64, 1 << 22])
def test_counts_do_not_depend_on_slices(monkeypatch, size):
    text = "Le le été été été  été\n### ### is is is a aa aa " * 7
    whole = quality_votes.slices
    monkeypatch.setattr(quality_votes, "slices", lambda data: whole(data, size))
    assert (quality_votes.term_counts(text.encode()) == plain_counts(text)).all()


def test_votes_equal_plain_votes():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.05, (90, quality_votes.TERMS)).astype(np.float32)
    counts[40:60] = counts[40]  # equal rows never compete
    model = quality_votes.train(counts, (np.arange(90) % 3 > 0).astype(float))
    asked = model.embed(np.concatenate([rng.poisson(0.05, (30, quality_votes.TERMS)), counts[40:41], 0 * counts[:1]]))
    got = model.votes(asked)
    assert np.allclose(got, plain_votes(model, asked), atol=1e-4)
    assert got[-1] == model.labels.mean()


def test_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_LARGER}/labels.parquet").collect()}
    rows = QUERIES["op11_neighbour_quality"](spark, SF_LARGER).collect()
    assert len(rows) == spark.read.parquet(f"{SF_LARGER}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    told = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = ([s for s, y in told if y == k] for k in (1, 0))
    ranked = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert len(bad) > 50 and ranked > 0.98
    assert np.mean(np.array(good) >= 0.3) > 0.99 and np.mean(np.array(bad) < 0.3) > 0.9


def test_strange_input(spark):
    rows = [(i, f"plain words number {i} of a text", "en", "x", "y", "k", "t") for i in range(40)]
    rows += [(100 + i, "%%% ### " * 9, "en", "x", "y", "k", "t") for i in range(10)]
    rows += [(7, rows[7][1], "en", "x", "y", "k", "t"), (None, "plain words", None, None, None, None, None)]
    rows += [(200, None, None, None, None, None, None), (201, "", None, None, None, None, None), (202, "ab " * 300_000, "", "", "", "", "")]
    docs = spark.createDataFrame(rows, DDL)
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(5)] + [(7, 1), (None, 0), (3, None), (999, 1), (200, 1)]
    marks = spark.createDataFrame(labels, "doc_id BIGINT, quality INT")
    model = quality_votes.fit(docs, marks, F.lit(True))
    assert len(model.labels) == 46  # keys with a text and a label, each once
    scored = quality_votes.score(docs, model, [F.col("doc_id"), F.col("label")])
    assert scored.columns == ["doc_id", "label", "score"]
    found = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert scored.count() == len(rows)
    assert found[109] < 0.3 < found[39] and found[200] == found[201] == pytest.approx(41 / 46)
    again = quality_votes.fit(docs.repartition(5), marks.repartition(3), F.lit(True))
    assert (again.vectors == model.vectors).all()
    assert quality_votes.score(docs.limit(0), model, [F.col("doc_id")]).count() == 0
    untaught = quality_votes.fit(docs, marks.limit(0), F.lit(True))
    assert {r["score"] for r in quality_votes.score(docs, untaught, [F.col("doc_id")]).collect()} == {0.5}
    few = quality_votes.fit(docs, marks, F.lit(True), rows=10)
    assert len(few.labels) == 10
