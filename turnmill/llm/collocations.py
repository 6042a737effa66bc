"""Phrase collocations from weighted acyclic automata.

A shard of text becomes a count transducer: an acyclic automaton over words, built
from the shard's sorted phrases, whose arc to the end of a phrase weighs what the
shard counts of it. It is cut into prefix ranges, and each range's automata are
united and their weights summed in one task. Phrases under the least count go then,
since no part of a candidate can be rarer than the candidate.

Phrases of one and two words come first. Those of three and four are counted only
where all their pairs may be frequent, by a bit table of bounded size that errs on
one side. The parts of a candidate are looked up by composing automata of parts with
the count transducers of the same range.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import slices, tasks, text_of
from turnmill.operators.positions import number_rows
from turnmill.session import save_step

WORDS = 4  # of the longest phrase
MIN_COUNT = 30
SHARD = 1 << 21  # words of a shard, about
RANGES = 2  # prefix ranges for each shuffle partition
SAMPLED_TEXTS = 256  # of an input partition, for the cuts between ranges
SAMPLED_KEYS = 64  # of an input partition and language
KEY_BYTES = 32  # of a word in a cut
BITS = (18, 28)  # least and greatest logarithm of the bit table's size
CHUNK_BITS = 18
TOP_PARTS = 64

_A_TO_Z = bytes(range(ord("A"), ord("Z") + 1))
#: A-Z in lower case, every separator a full stop, a tab a blank.
FOLD = bytes.maketrans(_A_TO_Z + b",;:!?\n\x0b\x0c\r\t", _A_TO_Z.lower() + b"." * 9 + b" ")


# --- automata -----------------------------------------------------------------


def tally(rows: np.ndarray, weights: np.ndarray | None, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and how often they occur or the sums of their weights.

    Rows are phrases of two or four word numbers, shorter ones filled up with -1.
    """
    base = n_words + 1
    pairs = [rows[:, i].astype(np.int64) * base + rows[:, i + 1] + (1 if i == 0 else base + 1) for i in range(0, rows.shape[1], 2)]
    if len(pairs) == 1:
        key, tables = pairs[0], None
    else:
        tables = [np.unique(p, return_inverse=True) for p in pairs]
        key = tables[0][1] * np.int64(max(1, len(tables[1][0]))) + tables[1][1]
    if weights is None:
        found, sums = np.unique(key, return_counts=True)
    else:
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        found = key[first]
        sums = np.add.reduceat(weights[order], first) if len(first) else weights[:0]
    if tables is None:
        halves = [found]
    else:
        place, other = np.divmod(found, max(1, len(tables[1][0])))
        halves = [tables[0][0][place], tables[1][0][other]]
    out = np.empty((len(found), rows.shape[1]), np.int32)
    for i, half in enumerate(halves):
        shift = 0 if i == 0 else base
        out[:, 2 * i] = (half - shift) // base
        out[:, 2 * i + 1] = (half - shift) % base - 1
    return out, sums.astype(np.int64)


@dataclass
class Level:
    """The states reached after some words, and their arcs, sorted by state and word."""

    first: np.ndarray  # of every state: its first arc; one more for the end
    label: np.ndarray  # of every arc: its word
    weight: np.ndarray  # of every arc: the count of the phrase that ends here
    target: np.ndarray  # of every arc: the next level's state, -1 for none


def _narrow(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(t).max))


class Automaton:
    """A weighted acyclic automaton over sorted words."""

    def __init__(self, words: list[bytes], levels: list[Level]):
        self.words = words
        self.levels = levels

    @classmethod
    def build(cls, words: list[bytes], rows: np.ndarray, weights: np.ndarray) -> Automaton:
        """From distinct sorted phrases. States that have the same single arc are one state,
        from the last words on; states without arcs are none."""
        n, depth = rows.shape
        changed = np.ones((n, depth), bool)
        if n > 1:
            changed[1:] = np.logical_or.accumulate(rows[1:] != rows[:-1], axis=1)
        fresh = changed & (rows >= 0)
        ends = np.arange(depth) == ((rows >= 0).sum(axis=1) - 1)[:, None]
        levels, state = [], np.empty(0, np.int64)
        for j in reversed(range(depth)):
            at = np.flatnonzero(fresh[:, j])  # the first phrase of every prefix of j + 1 words
            parent = np.cumsum(fresh[:, j - 1])[at] - 1 if j else np.zeros(len(at), np.int64)
            label, weight = rows[at, j], np.where(ends[at, j], weights[at], 0)
            target = state if j < depth - 1 else np.full(len(at), -1, np.int64)
            n_states = int(fresh[:, j - 1].sum()) if j else 1
            arcs = np.bincount(parent, minlength=n_states)
            kept = arcs > 0 if j else np.ones(1, bool)
            stands_for = np.arange(n_states)
            if j:  # the register of states with one arc
                single = np.flatnonzero(arcs[parent] == 1)
                if len(single):
                    order = single[np.lexsort((target[single], weight[single], label[single]))]
                    same = np.ones(len(order), bool)
                    same[1:] = (
                        (label[order[1:]] != label[order[:-1]])
                        | (weight[order[1:]] != weight[order[:-1]])
                        | (target[order[1:]] != target[order[:-1]])
                    )
                    leader = parent[order[same]][np.cumsum(same) - 1]
                    stands_for[parent[order]] = leader
                    kept &= stands_for == np.arange(n_states)
            number = np.where(kept, np.cumsum(kept) - 1, -1)
            state = np.where(arcs > 0, number[stands_for], -1)
            own = kept[parent]
            first = np.concatenate([[0], np.cumsum(arcs[kept])])
            levels.append(Level(first, label[own].astype(np.int64), weight[own], target[own]))
        return cls(words, levels[::-1])

    def _arcs(self, level: int, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each state's arcs among ``states``, and the arcs."""
        first = self.levels[level].first
        n = first[states + 1] - first[states]
        owner = np.repeat(np.arange(len(states)), n)
        return owner, np.arange(len(owner)) + np.repeat(first[states] - (np.cumsum(n) - n), n)

    def phrases(self, counts: Automaton | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All phrases, level by level, and their weights.

        With ``counts``, the composition of both: phrases of either, with the weights of
        ``counts``. Every step takes a state of each along an arc of the same word.
        """
        depth = len(self.levels)
        rows, weights = [np.empty((0, depth), np.int32)], [np.empty(0, np.int64)]
        paths, states = np.empty((1, 0), np.int32), np.zeros(1, np.int64)
        if counts:
            place = {w: i for i, w in enumerate(counts.words)}
            known = np.array([place.get(w, -1) for w in self.words] or [-1], np.int64)
            theirs = np.zeros(1, np.int64)
        for j, level in enumerate(self.levels[: len(counts.levels)] if counts else self.levels):
            owner, arc = self._arcs(j, states)
            paths = np.concatenate([paths[owner], level.label[arc, None].astype(np.int32)], axis=1)
            weight, states = level.weight[arc], level.target[arc]
            if counts:
                other = counts.levels[j]
                base = len(counts.words) + 1
                source = np.repeat(np.arange(len(other.first) - 1), np.diff(other.first))
                wanted = theirs[owner] * base + known[level.label[arc]]
                keys = source * base + other.label
                at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
                met = (keys[at] == wanted) & (known[level.label[arc]] >= 0) if len(keys) else np.zeros(len(arc), bool)
                paths, weight, states, at = paths[met], weight[met], states[met], at[met]
                weight, theirs = np.where(weight > 0, other.weight[at], 0), other.target[at]
            end = weight > 0
            rows.append(np.pad(paths[end], ((0, 0), (0, depth - j - 1)), constant_values=-1))
            weights.append(weight[end])
            on = states >= 0
            if counts:
                on &= theirs >= 0
                theirs = theirs[on]
            paths, states = paths[on], states[on]
        return np.concatenate(rows), np.concatenate(weights)

    def dump(self) -> bytes:
        """Words and arrays, each with its type and length; states by their number of arcs."""
        parts = [np.array([len(w) for w in self.words], np.int64), np.frombuffer(b"".join(self.words), np.uint8)]
        for x in self.levels:
            parts += [np.diff(x.first), x.label, x.weight, x.target + 1]
        out = [struct.pack("<B", len(self.levels))]
        for part in map(_narrow, parts):
            out += [struct.pack("<BQ", part.itemsize, len(part)), part.tobytes()]
        return b"".join(out)

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        at, parts = 1, []
        for _ in range(2 + 4 * data[0]):
            size, n = struct.unpack_from("<BQ", data, at)
            parts.append(np.frombuffer(data, f"<u{size}", n, at + 9))
            at += 9 + size * n
        text, ends = parts[1].tobytes(), np.cumsum(parts[0].astype(np.int64)).tolist()
        words = [text[a:b] for a, b in zip([0, *ends], ends)]
        levels = []
        for i in range(2, len(parts), 4):
            degree, label, weight, target = (p.astype(np.int64) for p in parts[i : i + 4])
            levels.append(Level(np.concatenate([[0], np.cumsum(degree)]), label, weight, target - 1))
        return cls(words, levels)


def unite(automata: list[Automaton], least: int = 1) -> Automaton:
    """The union; weights of equal phrases are summed, sums under ``least`` go."""
    words = sorted({w for a in automata for w in a.words})
    place = {w: i for i, w in enumerate(words)}
    depth = max((len(a.levels) for a in automata), default=2)
    rows, weights = [np.empty((0, depth), np.int32)], [np.empty(0, np.int64)]
    for a in automata:
        own, weight = a.phrases()
        to = np.array([*[place[w] for w in a.words], -1], np.int32)  # -1 stays
        rows.append(to[own])
        weights.append(weight)
    merged, sums = tally(np.concatenate(rows), np.concatenate(weights), len(words))
    return compact(words, merged[sums >= least], sums[sums >= least])


def compact(words: list[bytes], rows: np.ndarray, weights: np.ndarray) -> Automaton:
    """An automaton of sorted phrases, with the words that occur in them."""
    used = np.unique(rows[rows >= 0])
    to = np.full(len(words) + 1, -1, np.int32)
    to[used] = np.arange(len(used))
    return Automaton.build([words[i] for i in used.tolist()], to[rows], weights)


# --- shards -------------------------------------------------------------------


class Numbers(dict):
    """Numbers of words from 1 in order of first use; the full stop is 0."""

    def __init__(self):
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Shard:
    """Word numbers of the texts of one language, in order; 0 between pieces."""

    def __init__(self):
        self.numbers = Numbers()
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[str]) -> None:
        data = "\n".join(texts).encode().translate(FOLD)
        for start, end in slices(data):
            found = data[start:end].replace(b".", b" . ").split(b" ")
            numbers = np.array(list(map(self.numbers.__getitem__, filter(None, found))), np.int32)
            self.parts.append(numbers)
            self.size += len(numbers)
        self.parts.append(np.zeros(1, np.int32))

    def sorted_phrases(self, lengths: tuple[int, ...], frequent: Callable | None) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words, and the distinct phrases of ``lengths`` words with their counts.

        ``frequent`` says of two arrays of words which pairs can be frequent.
        """
        ids = np.concatenate([*self.parts, np.zeros(1, np.int32)])
        words = list(self.numbers)
        open_ = ids > 0
        if frequent:
            pair = np.zeros(len(ids), bool)
            at = np.flatnonzero(open_[:-1] & open_[1:])
            pair[at] = frequent(words, ids[at], ids[at + 1])
        rows, depth = [], max(lengths)
        for m in lengths:
            if len(ids) < m:
                continue
            last = len(ids) - m + 1
            whole = open_[:last].copy()
            for i in range(1, m):
                whole &= pair[i - 1 : last + i - 1] if frequent else open_[i : last + i]
            at = np.flatnonzero(whole)
            found = np.full((len(at), depth), -1, np.int32)
            for i in range(m):
                found[:, i] = ids[at + i]
            rows.append(found)
        rows = np.concatenate(rows) if rows else np.empty((0, depth), np.int32)
        used = np.flatnonzero(np.bincount(rows[rows >= 0], minlength=1)).tolist()
        used.sort(key=words.__getitem__)
        rank = np.full(len(words) + 1, -1, np.int32)
        rank[used] = np.arange(len(used), dtype=np.int32)
        return [words[i] for i in used], *tally(rank[rows], None, len(used))


Cut = tuple[bytes, ...]


def segments(lang: bytes, words: list[bytes], rows: np.ndarray, cuts: list[Cut]) -> Iterator[tuple[int, int, int]]:
    """Prefix range, start and end of the sorted phrases of a language, without empty ones.

    The range of a phrase is the number of cuts, of language and words, not above it.
    """
    rows = np.asfortranarray(rows)
    low = bisect_left(cuts, (lang,))
    places = [0]
    for cut in cuts[low:]:
        if cut[0] != lang:
            break
        start, end = 0, len(rows)
        for i, word in enumerate(cut[1 : rows.shape[1] + 1]):
            at = bisect_left(words, word)
            begin = start + int(np.searchsorted(rows[start:end, i], at))
            if at == len(words) or words[at] != word:
                start = begin
                break
            end = start + int(np.searchsorted(rows[start:end, i], at, side="right"))
            start = begin
        places.append(start)
    places.append(len(rows))
    for i, (start, end) in enumerate(zip(places, places[1:])):
        if end > start:
            yield low + i, start, end


def shards(batches: Iterator[pa.RecordBatch], size: int = SHARD) -> Iterator[tuple[str, Shard]]:
    """Shards by language of batches of language and text; together they have about ``size`` words."""
    held: dict[str, Shard] = {}
    for batch in batches:
        waiting: dict[str, list[str]] = {}
        weight = 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            waiting.setdefault(lang, []).append(text)
            weight += len(text)
            if weight >= 1 << 20:
                for key, texts in waiting.items():
                    held.setdefault(key, Shard()).add(texts)
                waiting, weight = {}, 0
                if sum(s.size for s in held.values()) >= size:
                    yield from held.items()
                    held = {}
        for key, texts in waiting.items():
            held.setdefault(key, Shard()).add(texts)
    yield from held.items()


# --- the bit table of pairs ---------------------------------------------------


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    prefix = lang.encode() + b"\n"
    return np.array([xxhash.xxh3_64_intdigest(prefix + w) for w in words], np.uint64)


def pair_places(first: np.ndarray, second: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of every pair of word hashes in a table of 2 ** bits."""
    mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed >> np.uint64(64 - bits), (mixed * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - bits)


def bit_table(pairs: DataFrame, n: int) -> np.ndarray:
    """The bits of all frequent pairs: two of at least 16 a pair, in at most 32 MB.

    A task makes each part of the table. A full table lets rare pairs through, which
    costs time, not results.
    """
    bits = min(max(BITS[0], int(16 * max(n, 1)).bit_length()), BITS[1])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Automaton.load(data.as_py())
                rows = own.phrases()[0]
                rows = rows[rows[:, 1] >= 0]
                h = word_hashes(lang, own.words)
                at = np.sort(np.concatenate(pair_places(h[rows[:, 0]], h[rows[:, 1]], bits)).astype(np.int64))
                chunks, starts = np.unique(at >> CHUNK_BITS, return_index=True)
                parts = np.split((at & ((1 << CHUNK_BITS) - 1)).astype("<u4"), starts[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunks, pa.int32()), pa.array([p.tobytes() for p in parts[: len(chunks)]], pa.binary())],
                    names=["chunk", "places"],
                )

    def gather(group: pa.Table) -> pa.Table:
        table = np.zeros(1 << CHUNK_BITS, bool)
        for data in group["places"]:
            table[np.frombuffer(data.as_py(), "<u4")] = True
        packed = np.packbits(table, bitorder="little").tobytes()
        return pa.table({"chunk": group["chunk"][:1], "bits": pa.array([packed], pa.binary())})

    found = pairs.select("lang", "automaton").mapInArrow(places, "chunk INT, places BINARY")
    table = np.zeros((1 << bits) // 8, np.uint8)
    for row in found.groupBy("chunk").applyInArrow(gather, "chunk INT, bits BINARY").collect():
        part = np.frombuffer(row["bits"], np.uint8)
        table[row["chunk"] * len(part) : (row["chunk"] + 1) * len(part)] = part
    return table


def may_be_frequent(lang: str, table: np.ndarray) -> Callable:
    bits = (len(table) * 8).bit_length() - 1

    def test(words: list[bytes], first: np.ndarray, second: np.ndarray) -> np.ndarray:
        h = word_hashes(lang, words)
        out = np.ones(len(first), bool)
        for places in pair_places(h[first], h[second], bits):
            out &= (table[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out

    return test


# --- the corpus ---------------------------------------------------------------

AUTOMATON = "range INT, lang STRING, automaton BINARY"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int32(), pa.string(), pa.binary()
    columns = zip(*rows) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["range", "lang", "automaton"])


def cut_points(texts: DataFrame, lengths: tuple[int, ...], table: Broadcast | None) -> list[Cut]:
    """Cuts of language and words that share the phrases out in equal ranges.

    They come from the first texts of every input partition and only balance the work.
    At most ``RANGES`` for each shuffle partition reach the driver.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = next(batches, None)
        keys = []
        if some is not None:
            for lang, shard in shards(iter([some.slice(0, SAMPLED_TEXTS)])):
                test = may_be_frequent(lang, table.value) if table else None
                words, rows, _ = shard.sorted_phrases(lengths, test)
                # A language with more phrases has more keys.
                for i in np.arange(0, len(rows), max(1, len(rows) // SAMPLED_KEYS)).tolist():
                    words_of = [words[w][:KEY_BYTES] for w in rows[i].tolist() if w >= 0]
                    keys.append(([lang.encode(), *words_of], len(rows)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in keys], pa.list_(pa.binary())), pa.array([n for _, n in keys], pa.int64())],
            names=["key", "n"],
        )

    keys = texts.mapInArrow(sample, "key ARRAY<BINARY>, n BIGINT")
    # As many rows of a key as its language's phrases in the partition ask for.
    keys = keys.withColumn("copy", F.explode(F.sequence(F.lit(0), F.least(F.floor(F.col("n") / 4096), F.lit(63)).cast("int"))))
    ranked = save_step(number_rows(keys.select("key", "copy"), "key"), "sampled_keys")
    n, wanted = ranked.count(), RANGES * tasks(texts.sparkSession)
    step = max(1, -(-n // wanted))
    found = ranked.filter((F.col("rank") % step == 0) & (F.col("rank") > 0)).select("key").collect()
    return sorted({tuple(bytes(w) for w in r["key"]) for r in found})


def count_phrases(
    texts: DataFrame, lengths: tuple[int, ...], least: int, table: Broadcast | None
) -> tuple[DataFrame, list[Cut]]:
    """The united automata of every prefix range and language, written, and the cuts.

    Columns: range, lang, automaton, n_words (of the range, before rare phrases go) and
    n_phrases (of the greatest of ``lengths``).
    """
    cuts = cut_points(texts, lengths, table)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in shards(batches):
            test = may_be_frequent(lang, table.value) if table else None
            words, rows, counts = shard.sorted_phrases(lengths, test)
            out = []
            for number, start, end in segments(lang.encode(), words, rows, cuts):
                out.append((number, lang, compact(words, rows[start:end], counts[start:end]).dump()))
                if len(out) >= 16:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    def merge(group: pa.Table) -> pa.Table:
        parts = [Automaton.load(x.as_py()) for x in group["automaton"]]
        n_words = 0 if min(lengths) > 1 else sum(int(a.levels[0].weight.sum()) for a in parts)
        whole = unite(parts, least)
        n_phrases = int((whole.phrases()[0][:, max(lengths) - 1] >= 0).sum())
        return pa.table(
            {
                "range": group["range"][:1],
                "lang": group["lang"][:1],
                "automaton": pa.array([whole.dump()], pa.binary()),
                "n_words": pa.array([n_words], pa.int64()),
                "n_phrases": pa.array([n_phrases], pa.int64()),
            }
        )

    merged = texts.mapInArrow(split, AUTOMATON).groupBy("range", "lang").applyInArrow(
        merge, f"{AUTOMATON}, n_words BIGINT, n_phrases BIGINT"
    )
    return save_step(merged, f"phrases_{max(lengths)}"), cuts


def listed(automata: DataFrame) -> DataFrame:
    """The phrases of automata: lang, phrase (joined by blanks), words, a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Automaton.load(data.as_py())
                rows, weights = own.phrases()
                yield phrase_batch(lang, own.words, rows, weights)

    return automata.select("lang", "automaton").mapInArrow(run, "lang STRING, phrase STRING, words INT, a BIGINT")


def phrase_batch(lang: str, words: list[bytes], rows: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    text = [w.decode() for w in words] + [""]
    joined = [" ".join([text[i] for i in row if i >= 0]) for row in rows.tolist()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(joined), pa.string()),
            pa.array(joined, pa.string()),
            pa.array((rows >= 0).sum(axis=1), pa.int32()),
            pa.array(weights, pa.int64()),
        ],
        names=["lang", "phrase", "words", "a"],
    )


def part_counts(short: DataFrame, long: DataFrame, short_cuts: list[Cut], long_cuts: list[Cut]) -> DataFrame:
    """Counts of all first parts and rests of the candidates: lang, part, f.

    Every automaton of candidates gives automata of their parts, cut at the ranges of
    the count transducers; both meet by range and are composed.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Automaton.load(data.as_py())
                rows = own.phrases()[0]
                sizes, depth, n = (rows >= 0).sum(axis=1), rows.shape[1], len(own.words)
                parts = []
                for m in range(2, depth + 1):
                    for k in range(1, m):
                        of = rows[sizes == m]
                        for piece in (of[:, :k], of[:, k:m]):
                            parts.append(np.pad(piece, ((0, 0), (0, WORDS - piece.shape[1])), constant_values=-1))
                every = tally(np.concatenate(parts), None, n)[0]
                small = (every >= 0).sum(axis=1) <= 2
                out = []
                for kind, some, cuts in ((0, every[small][:, :2], short_cuts), (1, every[~small], long_cuts)):
                    for number, start, end in segments(lang.encode(), own.words, some, cuts):
                        ones = np.ones(end - start, np.int64)
                        out.append((2 * number + kind, lang, compact(own.words, some[start:end], ones).dump()))
                yield _batch(out)

    def answer(questions: pa.Table, counts: pa.Table) -> pa.Table:
        if not questions.num_rows or not counts.num_rows:
            return pa.table({"lang": pa.array([], pa.string()), "part": pa.array([], pa.string()), "f": pa.array([], pa.int64())})
        asked = unite([Automaton.load(x.as_py()) for x in questions["automaton"]])
        rows, weights = asked.phrases(Automaton.load(counts["automaton"][0].as_py()))
        found = phrase_batch(questions["lang"][0].as_py(), asked.words, rows, weights)
        return pa.table({"lang": found.column(0), "part": found.column(1), "f": found.column(3)})

    sides = [(short, 0), (long, 1)]
    numbered = [x.select((2 * F.col("range") + kind).alias("range"), "lang", "automaton") for x, kind in sides]
    counts = numbered[0].unionAll(numbered[1])
    candidates = short.select("lang", "automaton").unionAll(long.select("lang", "automaton"))
    questions = candidates.mapInArrow(ask, AUTOMATON)
    # Columns of their own: a cogroup of two parts of one table confuses equal ones.
    counts = counts.select(*[F.col(c).alias(c) for c in counts.columns])
    met = questions.groupBy("range", "lang").cogroup(counts.groupBy("range", "lang"))
    return met.applyInArrow(answer, "lang STRING, part STRING, f BIGINT")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = MIN_COUNT,
    covered: int = 80,
    top: int = 2000,
) -> DataFrame:
    """The best phrases of two to four words of every language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z, cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into
    words ``[^\\x20\\x09]+``; phrases lie within pieces. A null text is empty, a null
    language ``und``; rows that repeat count again. Candidates occur ``least`` times (``a``).
    A candidate's cut after its first words gives l and r, the counts of both parts, and
    the score floor(2000000 * a / (l + r)); the lowest score counts, of equal ones that of
    the shortest first part. n is the number of words of the language. Candidates go that
    lie in a longer one with at least ``covered`` percent of their count. The first ``top``
    by score, count, then phrase in byte order are returned. All counts are exact.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    short, short_cuts = count_phrases(texts, (1, 2), least, None)
    n_pairs = short.agg(F.sum("n_phrases")).first()[0] or 0
    table = spark.sparkContext.broadcast(bit_table(short, n_pairs))
    long, long_cuts = count_phrases(texts, (3, 4), least, table)

    parts = save_step(part_counts(short, long, short_cuts, long_cuts), "part_counts")
    found = save_step(listed(short).filter("words > 1").unionAll(listed(long)), "candidates")
    totals = short.groupBy("lang").agg(F.sum("n_words").alias("n"))

    words = F.split("phrase", " ")
    inside = found.filter("words > 2").select(
        "lang",
        "a",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1),"
                " i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"
            )
        ).alias("phrase"),
    )
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = (
        found.join(longer, ["lang", "phrase"], "left")
        .filter(F.col("longest").isNull() | (100 * F.col("longest") < covered * F.col("a")))
        .drop("longest")
    )
    cut = kept.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).withColumns(
        {
            "first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("words")), " "),
        }
    )
    left = parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    wide = "decimal(38,0)"
    score = F.expr(f"cast(2000000 as {wide}) * cast(a as {wide}) div (cast(l as {wide}) + cast(r as {wide}))")
    scored = (
        cut.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumn("cut", F.struct(score.alias("score"), "k", "l", "r"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min("cut").alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The first of each part of a language, then of the language: no task sorts all its phrases.
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)).alias("part")
    some = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    best = scored.select("*", part).withColumn("place", some).filter(F.col("place") <= top).drop("place", "part")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score")
    )
