"""Pieces with almost the same members meet once, and nobody who shares a piece is missed."""

import random
from itertools import combinations

from turnmill.llm import jaccard


def members(spark, pieces, labels):
    rows = [(key, main, i, labels.get(i, i)) for key, (main, ids) in pieces.items() for i in ids]
    return spark.createDataFrame(rows, "key BIGINT, main BIGINT, id BIGINT, label BIGINT").repartition(3)


def test_pieces_of_one_main_label_are_united_if_that_is_less(spark):
    rng = random.Random(1)
    labels = {i: 1 for i in range(1, 11)}
    # Forty pieces of the same twenty sets, one or two missing in each; two that share but the main label.
    pieces = {k: (1, sorted(set(range(1, 21)) - {rng.randrange(1, 21), rng.randrange(11, 21)})) for k in range(100, 140)}
    pieces |= {200: (50, [50, 51, 52]), 201: (50, [50, 61, 62]), 202: (50, [50, 71, 72])}
    found = jaccard._united(members(spark, pieces, labels)).collect()
    met = {}
    for r in found:
        met.setdefault((r["main"], r["key"]), set()).add(r["id"])
    assert len(found) == sum(map(len, met.values()))
    assert met == {(1, 0): set(range(1, 21))} | {(50, k): set(pieces[k][1]) for k in (200, 201, 202)}
    assert {r["parts"] for r in found} == {1}


def test_parts_of_a_meeting_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART_MEMBERS", 3)
    rng = random.Random(7)
    shared = [f"s{i}" for i in range(60)]
    texts = []
    for group in range(12):  # a passage that all share, an own part, edited copies of it
        own = [f"w{group}_{i}" for i in range(60)]
        for _ in range(6):
            words = shared + own
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"x{rng.random()}"
            texts.append(" ".join(words))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(texts)), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(docs).collect()}
    assert found == {i: root(i) for i in range(len(texts))}
