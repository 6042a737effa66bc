"""A passage that many texts share does not make them meet."""

import numpy as np

from turnmill.llm import jaccard
from turnmill.llm.shingles import mix64


def test_similar_sets_share_more_keys_than_the_reserve():
    rng = np.random.default_rng(7)
    for n in (40, 90, 300, 1200):
        own = np.sort(mix64(rng.integers(0, 1 << 62, n, dtype=np.uint64)))
        for gone, new in ((n // 9, n // 9), (n // 5, 0), (0, n // 4)):
            other = np.sort(np.concatenate([own[gone:], mix64(rng.integers(0, 1 << 62, new, dtype=np.uint64))]))
            common = set(jaccard.piece_keys(own, 80)) & set(jaccard.piece_keys(other, 80))
            levels = [int(k) & ((1 << jaccard.LEVEL_BITS) - 1) for k in common]
            smaller = next(jaccard.levels(min(n, len(other)), 80))[0]
            assert levels.count(smaller) > jaccard.band(smaller, 80)[3]


def test_common_passage(spark, monkeypatch):
    rng = np.random.default_rng(8)
    passage = [f"p{i}" for i in range(60)]
    texts = [[f"w{x}" for x in rng.integers(0, 1 << 40, 300)] for _ in range(400)]
    texts = [t[:100] + passage + t[100:] for t in texts]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, " ".join(t[:-9] + ["other"] * 9)) for i, t in enumerate(texts[:20])]
    steps = {}
    save = jaccard.save_step

    def keep(df, name):
        steps[name] = save(df, name)
        return steps[name]

    monkeypatch.setattr(jaccard, "save_step", keep)
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {k: k % 1000 for k, _ in rows}
    # Only the copies of a text share what is left.
    assert steps["placed_pieces"].groupBy("key").count().filter("count > 2").count() == 0
    assert steps["stars"].count() == 20
