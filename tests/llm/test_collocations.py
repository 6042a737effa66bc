"""Phrase collocations: automata by themselves, all counts in plain Python, strange input."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill.llm import collocations
from turnmill.llm.collocations import Automaton, Shard, compact, segments, tally, unite

DDL = "doc_id BIGINT, text STRING, lang STRING, phrase STRING, a STRING, n STRING, rank STRING"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, covered=80, top=2000):
    counts = {}
    for text, lang in rows:
        found = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for m in range(1, 5):
                found.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, found in counts.items():
        n = sum(c for p, c in found.items() if len(p) == 1)
        candidates = {p: c for p, c in found.items() if len(p) > 1 and c >= least}
        gone = {
            p[i:j]
            for p, c in candidates.items()
            for i in range(len(p))
            for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * c >= covered * candidates[p[i:j]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                cuts = [(2000000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def mined(spark, rows, least, **options):
    docs = spark.createDataFrame([(i, t, g, "p", "a", "n", "r") for i, (t, g) in enumerate(rows)], DDL)
    found = collocations.collocations(docs.repartition(3), least=least, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


def test_equals_plain_python(spark):
    rng = random.Random(7)
    words = ["The", "of", "été", "a", "b\x00c", "日本", "x\x01", "-", "ab", "zz"]
    fixed = ["in the nick of time", "of the", "a b a b a b", "été zz"]
    rows = []
    for _ in range(160):
        parts = [rng.choice(words) if rng.random() < 0.6 else rng.choice(fixed) for _ in range(rng.randrange(60))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "!", " ", " "]) for p in parts)
        rows.append((text, rng.choice(["en", "en", "en", "fr", None, "und"])))
    rows += [(None, "en"), ("", "fr"), (" \t.\n", None), (rows[0][0], "en"), (rows[0][0], "en")]
    want = plain(rows, 12)
    assert len(want) > 100 and mined(spark, rows, 12) == want
    assert mined(spark, rows, 12, top=5) == plain(rows, 12, top=5)
    assert mined(spark, rows, 3, covered=50) == plain(rows, 3, covered=50)


def test_strange_input(spark):
    long = "on and on " * 40_000  # one piece of 120,000 words
    rows = [(long, "en"), ("x" * 300_000, "en"), ("one two", None)]
    assert mined(spark, rows, 30) == plain(rows, 30)
    assert mined(spark, [], 30) == [] == mined(spark, [(None, None)], 1)
    # Beyond the least count by one, and one short of it.
    edge = [("p q", "en")] * 30 + [("r s", "en")] * 29
    assert [r[2] for r in mined(spark, edge, 30)] == ["p q"]


def test_small_shards_and_slices(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(" ".join(rng.choice("abcdefgh") for _ in range(200)), rng.choice(["en", "de"])) for _ in range(40)]
    want = plain(rows, 10)
    whole = collocations.slices
    monkeypatch.setattr(collocations, "slices", lambda data: whole(data, 16))
    shards = []
    for at in range(0, 40, 3):
        shard = Shard()
        shard.add([t for t, lang in rows[at : at + 3] if lang == "en"])
        words, found, counts = shard.sorted_phrases((3, 4), None)
        shards.append(compact(words, found, counts))
    union = unite(shards, 10)
    found = {" ".join(union.words[i].decode() for i in r if i >= 0): w for r, w in zip(*union.phrases())}
    every = Counter()
    for text, lang in rows:
        if lang == "en":
            w = text.split()
            every.update(" ".join(w[i : i + m]) for m in (3, 4) for i in range(len(w) - m + 1))
    assert found == {p: c for p, c in every.items() if c >= 10} and found
    assert mined(spark, rows, 10) == want


@pytest.mark.parametrize("seed", range(6))
def test_automata(seed):
    rng = random.Random(seed)
    letters = [b"a", b"b", b"c\x00", b"\xc3\xa9", b"d e"[:1], b"zz"]

    def random_counts(n):
        c = Counter()
        for _ in range(n):
            c[tuple(rng.choice(letters) for _ in range(rng.randint(1, 4)))] += rng.choice([1, 1, 1, 2, 300, 70_000])
        return c

    def automaton(counts):
        words = sorted({w for p in counts for w in p})
        rows = np.array([[words.index(w) for w in p] + [-1] * (4 - len(p)) for p in counts], np.int32).reshape(-1, 4)
        rows, weights = tally(rows, np.array(list(counts.values()), np.int64), len(words))
        return Automaton.build(words, rows, weights)

    def phrases(a, other=None):
        rows, weights = a.phrases(other)
        return {tuple(a.words[i] for i in r if i >= 0): w for r, w in zip(rows.tolist(), weights.tolist())}

    one, two = random_counts(rng.randrange(200)), random_counts(rng.randrange(1, 90))
    a, b = automaton(one), automaton(two)
    assert phrases(a) == one and phrases(Automaton.load(a.dump())) == one
    assert phrases(unite([a, b, a])) == one + two + one
    assert phrases(a, b) == {p: two[p] for p in one if p in two}
    # Equal single arcs are one state: fewer states than prefixes.
    if len(one) > 60:
        states = sum(len(x.first) - 1 for x in a.levels)
        assert states < 1 + len({p[:i] for p in one for i in range(1, len(p)) if any(q[:i] == p[:i] and len(q) > i for q in one)})
    # Every phrase lies in the range that counts the cuts up to it.
    words = a.words
    rows, _ = a.phrases()
    rows, _ = tally(rows, None, len(words))
    cuts = sorted({(rng.choice([b"de", b"en", b"fr"]), *(rng.choice([*letters, b"m"]) for _ in range(rng.randint(1, 3)))) for _ in range(9)})
    for number, start, end in segments(b"en", words, rows, cuts):
        for r in rows[start:end].tolist():
            assert number == sum(c <= (b"en", *(words[i] for i in r if i >= 0)) for c in cuts)
    assert sum(end - start for _, start, end in segments(b"en", words, rows, cuts)) == len(rows)


def test_a_full_bit_table_loses_nothing(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(" ".join(rng.choice("abcdefghijklmnop") for _ in range(300)), "en") for _ in range(20)]
    monkeypatch.setattr(collocations, "bit_table", lambda pairs, n: np.full(1 << 12, 255, np.uint8))
    assert mined(spark, rows, 4) == plain(rows, 4)


def test_rare_pairs_are_left_out():
    table = np.zeros(1 << 15, np.uint8)
    test = collocations.may_be_frequent("en", table)
    shard = Shard()
    shard.add(["a b c d e f g"])
    assert len(shard.sorted_phrases((3, 4), test)[1]) == 0 and len(shard.sorted_phrases((3, 4), None)[1]) == 9


def test_counts_follow_the_input(spark):
    docs = spark.range(300).select(F.lit("same words here").alias("text"), F.lit("en").alias("lang"))
    (row,) = collocations.collocations(docs).collect()
    assert tuple(row) == ("en", 1, "same words here", 300, 300, 300, 900, 1_000_000)
