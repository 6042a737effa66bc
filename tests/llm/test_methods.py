"""The dealt operators against plain Python, round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow.fs
import pytest
from conftest import SF
from tokenizers import Tokenizer

from turnmill.llm import exact, fingerprints, jaccard, language, substring_dedup, token_counts, warc
from turnmill.llm.common import new_folder
from turnmill.llm.queries import ORACLE, QUERIES
from turnmill.llm.shingles import Shingler
from turnmill.llm.tokens import WORD_BPE, tokenizer


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")

    def rows(frame):
        frame = frame[sorted(frame.columns)]
        frame = frame.astype(object).where(frame.notna(), None)
        return sorted((tuple(r) for r in frame.itertuples(index=False)), key=repr)

    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.execute(ORACLE[name]).fetchdf())


def test_packing_equals_full_encoding(spark, texts):
    model = Tokenizer.from_file(WORD_BPE)
    found = {}
    for r in QUERIES["op7_power_of_two_packing"](spark, SF).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert found.keys() == texts.keys()
    for doc, pieces in found.items():
        ids = model.encode(texts[doc], add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            n = r["length"]
            assert r["start"] == at and n & (n - 1) == 0 and n <= 2048 and r["offset"] == 0
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())
            assert r["doc_tokens"] == len(ids)
            at += n
        assert at == len(ids)


def test_cached_tokens_equal_full_encoding():
    model = Tokenizer.from_file(WORD_BPE)
    odd = ["İstanbul ΣΑΣ straße é", "a\x1cb\xa0d　e", "it's we'll I'D don't", "x<|endoftext|>y", "日本 4.5 Å ﬁ µ ª ²½ × ÿ", "\x7f\x00 a" * 40]
    for text in odd:
        assert np.frombuffer(tokenizer(WORD_BPE).ids(text), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_token_counts_equal_tokens(spark, texts):
    own = tokenizer(WORD_BPE, "<u2", True)
    want = {d: len(own.ids(t)) // 2 for d, t in texts.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in QUERIES["op6_token_counts"](spark, SF).collect()} == want


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_blocks_are_stitched(spark, block):
    """Documents that span many blocks, end at block ends, or are empty."""
    sizes = [0, 5, 0, 0, 40, 1, 3, 200, 0, 2]
    folder = new_folder(spark, "flat")
    data = np.concatenate([np.append(np.full(n, 7, "<u2"), 9).astype("<u2") for n in sizes]).tobytes()
    system, path = pyarrow.fs.FileSystem.from_uri(folder)
    with system.open_output_stream(f"{path}/x.bin") as out:
        out.write(data)
    files = spark.createDataFrame([("x.bin", len(data))], "file STRING, bytes BIGINT")
    rows = token_counts.count_tokens(spark, files, folder, end=9, block=block).collect()
    assert [r["n_tokens"] for r in sorted(rows, key=lambda r: r["ordinal"])] == sizes


def test_warc_files_are_checked(spark):
    good = [warc.record("1", "u\r\nX: y", b"abc", None), warc.record("2", "", b"abc", "1")]
    import gzip

    stream = b"".join(gzip.compress(r) for r in good)
    parts = list(warc.members(stream[i : i + 7] for i in range(0, len(stream), 7)))
    assert parts == good
    assert [warc.parse(p)["payload"] for p in parts] == [b"abc", None]
    with pytest.raises(ValueError):
        warc.parse(good[0].replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        list(warc.members(iter([stream[:-3]])))


def test_extendible_directory():
    counts = {0: 50, 1: 50, 40_000: 1000}
    cells = exact.directory(counts, 10)
    assert len(cells) == 1 << exact.MAX_DEPTH  # the hot prefix is split as far as bits go
    assert cells[0][0] != cells[1][0] and cells[40_000][1] == exact.MAX_DEPTH
    assert [b for b, _ in cells] == sorted(b for b, _ in cells)
    assert exact.directory({}, 10) == [(0, 0)]


def test_colliding_keys_are_chained():
    import pyarrow as pa

    rows = [(0, 0, 7, "a", 3, 5, 1), (0, 0, 7, "b", 3, 4, 1), (0, 0, 7, "a", 3, 2, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), exact.ENTRY)], schema=exact.ENTRY)
    out = [r for b in exact._chain(iter([batch])) for r in b.to_pylist()]
    assert [(r["chain"], r["norm"], r["best_id"], r["copies"]) for r in out] == [(0, "a", 2, 3), (1, "b", 4, 1)]


def words(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def test_jaccard_equals_all_pairs(spark):
    """Near copies of many degrees, and unrelated texts that share a passage."""
    rng = random.Random(3)
    notice, made = words(rng, 30), []
    for _ in range(12):
        base = words(rng, rng.choice([3, 5, 8, 20, 60, 150]))
        for edits in (0, 0, 1, 1, 2, 3, 5, 8, 12):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            made.append(" ".join(copy))
    made += [" ".join(words(rng, 6) + notice) for _ in range(25)] + ["", "x"]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id BIGINT, text STRING")
    sets = [{tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if (w := t.split()) else set() for t in made]
    label = list(range(len(made)))
    for a, b in combinations(range(len(made)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    got = jaccard.similar_groups(docs, words=4, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {
        i: (len(s), label[i]) for i, s in enumerate(sets)
    }


def test_similar_sets_share_a_piece():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 6, 7, 12, 13, 40, 150, 700):
        for percent in (80, 85):
            own = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            most = n * (100 - percent) // 100  # so many may go: common n - most, union n
            part = np.sort(rng.permutation(own)[: n - most])
            assert set(jaccard.piece_keys(own, percent)) & set(jaccard.piece_keys(part, percent))
            changed = n * (100 - percent) // (100 + percent)
            other = np.sort(np.concatenate([rng.permutation(own)[: n - changed], rng.integers(0, 1 << 63, changed, dtype=np.uint64)]))
            assert set(jaccard.piece_keys(own, percent)) & set(jaccard.piece_keys(other, percent))


def test_shingles_equal_plain_words():
    rng = random.Random(1)
    made = [" ".join(words(rng, n)).upper() + "\n" for n in (0, 1, 3, 4, 5, 200)] + ["é  É\ta\x0bB c"]
    for text, own in zip(made, Shingler(4).sets([t.encode() for t in made])):
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        assert len(own) == (len({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))}) if w else 0)


def brute_tuples(text):
    """Order MinHash by its definition: number, order, select, return to text order."""
    tokens = re.findall(r"[^\x20\x09-\x0D]{1,12}", text)
    k = fingerprints.WORDS
    runs = [tuple(tokens[i : i + k]) for i in range(max(1, len(tokens) - k + 1))]
    seen, out = {}, []
    for i, run in enumerate(runs):
        n = seen.get(run, 0)
        seen[run] = n + 1
        digest = int.from_bytes(hashlib.sha1(repr((run, n)).encode()).digest()[:8], "big")
        out.append((digest, i, (run, n)))
    made = []
    for j in range(fingerprints.ORDERS):
        turned = sorted(((d ^ (j << (64 - fingerprints.ORDER_BITS))), i, x) for d, i, x in out)[: fingerprints.PICKED]
        made.append(tuple(x for _, _, x in sorted(turned, key=lambda t: t[1])))
    return made


def test_order_minhash_estimates_like_its_definition(spark, texts):
    rows = QUERIES["op5_order_minhash"](spark, SF).collect()
    ids = sorted(texts)
    near, want = [], []
    for r in rows:
        i = ids.index(r["doc_id"])
        text, after = texts[ids[i]], texts[ids[(i + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        same = sum(a == b for a, b in zip(brute_tuples(text), brute_tuples(edited)))
        near.append(r["near_edited"])
        want.append(same / fingerprints.ORDERS)
    assert len({r["fingerprint"] for r in rows}) >= len(set(texts.values()))
    # Other hash functions: equal on average, not text by text.
    assert abs(np.mean(near) - np.mean(want)) < 0.03
    assert np.mean([r["near_next"] for r in rows]) < 0.02


def test_moved_passages_are_edits(spark):
    rng = random.Random(8)
    a, b = " ".join(words(rng, 200)), " ".join(words(rng, 200))
    rows = spark.createDataFrame([(f"{a} {b}", f"{b} {a}")], "x STRING, y STRING")
    both = rows.select(fingerprints.fingerprint(rows.x).alias("x"), fingerprints.fingerprint(rows.y).alias("y"))
    moved = both.select(fingerprints.likeness("x", "y").alias("l")).first()["l"]
    assert 0.2 < moved < 0.8  # the runs are the same, the order of half the pairs is not


def test_repeated_runs_are_numbered(spark):
    """A text of one repeated run has as many selected runs as a text of different ones."""
    rows = spark.createDataFrame([("a " * 300,), ("a " * 150,)], "t STRING")
    found = [r["f"] for r in rows.select(fingerprints.fingerprint(rows.t).alias("f")).collect()]
    assert len(set(found[0])) > fingerprints.ORDERS / 2
    same = sum(x == y for x, y in zip(*found)) / fingerprints.ORDERS
    assert 0.05 < same < 0.6  # half of the numbered runs


def test_language_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op3_language_id"](spark, sf).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) > 0.97


def test_parse_equals_longest_matches():
    """Phrases by the table of moves equal a greedy parse by substring search."""
    rng = random.Random(2)
    sample = {x: ["".join(rng.choice(a) for _ in range(300))] for x, a in (("p", "aab c"), ("q", "abd e"))}
    model = language.train(sample)
    made = ["".join(rng.choice("abcdez ") for _ in range(n)) for n in (1, 2, 50, 400)]
    bits, _ = model.entropies(made)
    for i, lang in enumerate(model.languages):
        text = "".join(chr(c) for c in language.symbols(sample[lang][0])[: language.SAMPLE_SYMBOLS])
        for j, made_text in enumerate(made):
            left, phrases = "".join(chr(c) for c in language.symbols(made_text)), 0
            while left:
                n = 1
                while n < len(left) and left[: n + 1] in text:
                    n += 1
                left, phrases = left[n:], phrases + 1
            assert bits[i, j] == pytest.approx(phrases * model.bits[i])


def test_insertions_do_not_shift_chunks():
    rng = random.Random(4)
    data = " ".join(words(rng, 400)).encode()
    chunks = [
        {d[a:b] for a, b in zip([0, *e], e)}
        for d in (data, b"inserted here " + data)
        for e in [substring_dedup.cuts(np.frombuffer(d, np.uint8)).tolist()]
    ]
    assert len(chunks[0] & chunks[1]) >= len(chunks[0]) - 3
    flat = substring_dedup.cuts(np.frombuffer(b"a" * 10_000, np.uint8))
    assert np.diff(flat, prepend=0).max() <= substring_dedup.MOST
