"""Hard negatives against plain Python, with ties, repeats, signs, sizes and strange rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill.llm import hard_negatives
from turnmill.llm.hard_negatives import Scan, columns, in_windows, nearest

DDL = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, rid STRING, block STRING, anchor STRING, score STRING"


def plain(rows, every, positives=5, negatives=3):
    """All hard negatives, every pair computed."""
    sound = [
        (i, key, [max(-(2**63), min(2**63 - 1, math.floor(256 * x))) for x in v], label)
        for i, (key, v, label) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]

    def first(found, count):
        return sorted(found, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:count]

    out = []
    for i, key, v, label in sound:
        if key is None or key % every:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), k, other) for j, k, w, other in sound if j != i]
        for p, positive, _ in first([s for s in scores if s[2] == label], positives):
            p = max(-(2**63), min(2**63 - 1, p))
            fit = [s for s in scores if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p]
            for rank, (n, negative, _) in enumerate(first(fit, negatives), 1):
                out.append((key, positive, rank, negative, p, n))
    return Counter(out)


def mined(spark, rows, every, **options):
    frame = spark.createDataFrame([(k, v, y, "r", "b", "a", "s") for k, v, y in rows], DDL).repartition(3)
    found = hard_negatives.mine(frame, F.col("vec_id") % every == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize("block", [7, 10_000])
def test_equals_plain_python(spark, block):
    rng = random.Random(block)
    centres = [[rng.gauss(0, 1) for _ in range(19)] for _ in range(3)]
    rows = []
    for i in range(150):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, 0.6) for x in c], rng.randrange(3)))
    rows += [(500 + i, rows[i % 9][1], rng.randrange(3)) for i in range(40)]  # equal vectors: ties
    assert (want := plain(rows, 5)) and mined(spark, rows, 5, block=block) == want


def test_strange_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0, 2.0]) for _ in range(4)], i % 2) for i in range(40)]
    rows += [rows[0], rows[0], rows[3], (None, [1.0, 1.0, 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0, 1.0], 1)]
    rows += [(50, None, 1), (60, [1.0, None], 0), (70, [1.0, math.nan], 0), (80, [math.inf], 1), (90, [1.0], None)]
    rows += [(100, [], 0), (110, [3.0], 1), (120, [1.0] * 6, 0)]
    assert mined(spark, rows, 10) == plain(rows, 10)
    assert mined(spark, [], 10) == Counter() == mined(spark, rows[40:41], 10)


def test_large_components(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.randrange(9) for _ in range(5)], i % 2) for i in range(60)]
    assert mined(spark, rows, 10) == plain(rows, 10)
    huge = [(0, [1e30], 0), (1, [1e30], 0), (2, [1e30], 1)]
    assert mined(spark, huge, 10) == Counter()  # 100 percent is too near, in exact numbers too


@pytest.mark.parametrize("kind", [np.int32, np.int64, object])
def test_scans_lose_nothing(kind):
    rng = np.random.default_rng(4)
    for _ in range(30):
        matrix = rng.integers(-9, 10, (rng.integers(1, 60), 37)).astype(kind)
        query = rng.integers(-9, 10, 37).astype(kind)
        scores = matrix @ query
        rows, sums = nearest(query, columns(matrix), 3)
        assert (sums == scores[rows]).all()
        assert sorted(sums.tolist())[-3:] == sorted(scores.tolist())[-3:]
        some = np.flatnonzero(rng.random(len(matrix)) < 0.8)
        windows = [(20, 60), (-5, 30)]
        rows, sums = in_windows(query, columns(matrix), some, windows, 3)
        assert set(rows.tolist()) <= set(some.tolist()) and (sums == scores[rows]).all()
        for low, high in windows:
            best = [sorted(s for s in x.tolist() if low <= s <= high)[-3:] for x in (scores[some], sums)]
            assert best[0] == best[1]


def test_bounds_prune():
    """An anchor with few large components settles most rows before the last columns."""
    rng = np.random.default_rng(6)
    matrix = rng.integers(-50, 51, (2000, 64)).astype(np.int64)
    query = np.where(np.arange(64) % 8 == 0, 90, 1).astype(np.int64)
    scan = Scan(query, columns(matrix))
    scan.more()
    low, high = scan.bounds()
    assert (low <= matrix @ query).all() and (matrix @ query <= high).all()
    assert (high >= np.sort(low)[-6]).sum() < 100
