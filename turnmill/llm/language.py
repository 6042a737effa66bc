"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of a bounded sample of its labelled text. A
text is parsed greedily into the longest phrases that occur in the sample; few,
long phrases mean that the text resembles it. Phrases times the logarithm of the
sample's length, per symbol, is the cross-parsing entropy in bits; the language
with the least wins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from turnmill.llm.common import each, text_of

UNKNOWN = "und"
SAMPLE_ROWS = 48  # labelled rows of each language that a model learns from
SAMPLE_SYMBOLS = 1_000  # symbols of each such row
SYMBOLS = 256  # codes with a column in the table of moves; rarer symbols are looked up
BLOCK = 1024  # symbols that are parsed together; a phrase ends with its block
SPARE = 2  # phrases that a text has free before its rate counts
CHUNK = 2_000_000  # code points of texts that are handled together


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def symbols(text: str) -> np.ndarray:
    """Lower-case letters; every run of other characters is one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    return np.where(letter, points, 32)[letter | np.concatenate([[True], letter[:-1]])].astype(np.uint32)


def suffix_automaton(text: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of the automaton of all substrings: a table of codes below ``width``, -1
    where there is none, and rows of state, code and target for the other codes."""
    steps: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        state = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = state
            p = link[p]
        if p >= 0:
            q = steps[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(steps)
                steps.append(dict(steps[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    table = np.full((len(steps), width), -1, np.int32)
    rare = []
    for state, edges in enumerate(steps):
        for c, target in edges.items():
            if c < width:
                table[state, c] = target
            else:
                rare.append((state, c, target))
    return table, np.array(rare, np.int64).reshape(-1, 3)


@dataclass
class Model:
    """Languages, alphabet, and one table of all automata for parsing.

    ``moves[state * width + symbol]`` is the next state's row start times four plus
    the phrases that end with this step: one if the symbol starts a new phrase, two if
    it is a phrase of its own after an ended one. Codes from ``width`` on are of symbols
    that are too many for the table: ``rare_moves`` of the sorted ``rare_keys`` (state and
    code), and ``rare_misses`` of a language and code where a state has no such move.

    ``levels`` are the bits per symbol, in each language, that a text may need; a text
    that needs more in the language that wins is of none. Without them all texts are of one.
    """

    languages: list[str]
    alphabet: np.ndarray
    codes: np.ndarray
    moves: np.ndarray
    roots: np.ndarray
    bits: np.ndarray
    width: int
    rare_keys: np.ndarray
    rare_moves: np.ndarray
    rare_misses: np.ndarray
    levels: np.ndarray | None = None

    def rare(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Moves of the states of every language by codes that have no column."""
        code = code - self.width
        keys = state.astype(np.int64) // self.width * self.rare_misses.shape[1] + code
        place = np.searchsorted(self.rare_keys, keys)
        place[place == len(self.rare_keys)] = 0
        roots = self.roots[:, None].astype(np.int64)
        missed = np.where(state == roots, roots << 2 | 1, self.rare_misses[:, code])
        return np.where(self.rare_keys[place] == keys, self.rare_moves[place], missed)

    def phrases(self, blocks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of every block in every language; blocks sorted by falling length."""
        found = np.zeros((len(self.roots), len(lengths)), np.int64)
        state = np.repeat(self.roots[:, None], len(lengths), axis=1)
        columns = np.ascontiguousarray(blocks.T)
        tabled = columns < self.width
        dense = columns if tabled.all() else np.where(tabled, columns, 0)
        lookups = ~tabled.all(axis=1)
        for i in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -i, side="left"))
            move = self.moves[state[:, :active] + dense[i, :active]]
            if lookups[i]:
                at = np.flatnonzero(~tabled[i, :active])
                move[:, at] = self.rare(state[:, at], columns[i, at])
            state[:, :active] = move >> 2
            found[:, :active] += move & 3
        return found + (state != self.roots[:, None])

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of every text in every language, and symbols of every text."""
        rows = [symbols(t) for t in texts]
        sizes = np.array([len(r) for r in rows])
        flat = np.concatenate(rows) if rows else np.empty(0, np.uint32)
        place = np.searchsorted(self.alphabet, flat)
        place[place == len(self.alphabet)] = 0
        codes = np.where(self.alphabet[place] == flat, self.codes[place], 0).astype(np.int32)
        counts = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        lengths = np.minimum(sizes[owner] - inside * BLOCK, BLOCK)
        start = (np.cumsum(sizes) - sizes)[owner] + inside * BLOCK
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max()) if len(lengths) else 0
        padded = np.concatenate([codes, np.zeros(longest, np.int32)])
        blocks = padded[start[order][:, None] + np.arange(longest)]
        found = self.phrases(blocks, lengths[order])
        total = np.zeros((len(self.roots), len(sizes)), np.int64)
        for i in range(len(self.roots)):
            total[i] = np.bincount(owner[order], weights=found[i], minlength=len(sizes))
        return total * self.bits[:, None], sizes

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of every text. The score is the winner's share of
        the probabilities that the bits stand for; a text without letters or over the
        winner's level has none."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        bits, sizes = self.entropies(texts)
        odds = np.exp2(np.clip(bits.min(axis=0) - bits, -60, 0))
        best = bits.argmin(axis=0)  # the first of equals
        score = 1 / odds.sum(axis=0)
        fits = np.ones(len(texts), bool)
        if self.levels is not None:
            fits = bits.min(axis=0) <= sizes * self.levels[best] + SPARE * self.bits[best]
        letters = _letters()
        named, scores = [], []
        for text, b, s, fit in zip(texts, best.tolist(), score.tolist(), fits.tolist()):
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            known = fit and bool(letters[points].any())
            named.append(self.languages[b] if known else UNKNOWN)
            scores.append(float(s) if known else 0.0)
        return named, scores


def train(sample: dict[str, list[str]]) -> Model:
    """A model of each language's texts."""
    texts = {lang: [symbols(t)[:SAMPLE_SYMBOLS] for t in sample[lang]] for lang in sorted(sample)}
    seen: Counter = Counter()
    for rows in texts.values():
        for row in rows:
            seen.update(row.tolist())
    ranked = sorted(seen, key=lambda c: (-seen[c], c)) or [32]
    code = {c: i + 1 for i, c in enumerate(ranked)}
    alphabet = np.array(sorted(ranked), np.uint32)
    codes = np.array([code[c] for c in alphabet.tolist()], np.int32)
    width = min(len(ranked) + 1, SYMBOLS)
    n_rare = len(ranked) + 1 - width
    rare_keys, rare_moves = [], []
    rare_misses = np.empty((len(texts), n_rare), np.int64)
    tables, roots, bits, base = [], [], [], 0
    for rows in texts.values():
        text = [code.get(c, 0) for row in rows for c in [*row.tolist(), 0]]
        own, edges = suffix_automaton(text, width)
        own[:, 0] = -1  # the end of a row and unknown symbols match nothing
        by, symbol, to = edges.T
        rare_keys.append((by + base) * n_rare + symbol - width)
        rare_moves.append((to + base) * width << 2)
        begin = by == 0
        rare_misses[len(roots)] = base * width << 2 | 2
        rare_misses[len(roots), symbol[begin] - width] = rare_moves[-1][begin] | 1
        start = np.where(own[0] >= 0, own[0], 0)
        missing = own < 0
        # After a miss the symbol starts a phrase, or is one if no phrase starts with it.
        target = np.where(missing, start[None, :], own)
        ended = missing.astype(np.int8) + (missing & (own[0] < 0)[None, :])
        ended[0] = own[0] < 0  # nothing was open at the root
        moved = target.astype(np.int64)
        moved += base
        moved *= width
        moved <<= 2
        moved |= ended
        # 32-bit moves halve the memory of the driver, and what the parse runs through.
        tables.append(moved.astype(np.int32 if (base + len(own)) * width << 2 < 2**31 else np.int64).ravel())
        roots.append(base * width)
        bits.append(log2(max(2, len(text))))
        base += len(own)
    moves = np.concatenate(tables) if tables else np.empty(0, np.int64)
    kind = np.int32 if base * width << 2 < 2**31 else np.int64
    keys, lookups = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rare_keys, rare_moves))
    order = np.argsort(keys)
    return Model(
        list(texts),
        alphabet,
        codes,
        moves.astype(kind, copy=False),
        np.array(roots, kind),
        np.array(bits),
        width,
        keys[order],
        lookups[order],
        rare_misses,
    )


def levels(sample: dict[str, list[str]], model: Model) -> np.ndarray:
    """Bits per symbol that a text of each language may need, without two rows any number.

    The geometric mean of a phrase per symbol, which is what an unlearned script needs, and
    of what the worst row of the sample needs when the other half is learnt, or a code of
    the sample's symbols, if that is more.
    """
    most = np.full(len(model.languages), np.inf)
    for i, lang in enumerate(model.languages):
        rows = sample[lang]
        if len(rows) < 2:
            continue
        seen = set(np.concatenate([symbols(t)[:SAMPLE_SYMBOLS] for t in rows]).tolist())
        most[i] = log2(len(seen) + 1)
        for own, other in ((rows[::2], rows[1::2]), (rows[1::2], rows[::2])):
            half = train({lang: other})
            bits, sizes = half.entropies(own)
            phrases = bits[0] / half.bits[0]
            most[i] = max(most[i], ((phrases - SPARE) * model.bits[i] / np.maximum(sizes, 1)).max())
    return np.sqrt(most * model.bits)


def fit(
    docs: DataFrame,
    training: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    reject: bool = False,
) -> Model:
    """Learn from a bounded sample: ``SAMPLE_ROWS`` rows of each language, the first
    by a hash of their key, ``SAMPLE_SYMBOLS`` symbols of each. Rows without text,
    language or letters teach nothing. Spark limits the rows before the shuffle.
    With ``reject`` the model has levels, so that texts of no learned language are ``und``.
    """
    rows = docs.filter(training & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("turn")
    )
    rows = rows.filter(F.col("text").rlike(r"\p{L}"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("turn"))
    chosen = rows.withColumn("place", place).filter(F.col("place") <= SAMPLE_ROWS)
    # Twice as many code points hold the symbols of all but strange rows.
    chosen = chosen.select("lang", "place", F.substring("text", 1, 2 * SAMPLE_SYMBOLS).alias("text"))
    sample: dict[str, list[str]] = {}
    for lang_value, _, value in sorted(tuple(r) for r in chosen.collect()):
        sample.setdefault(lang_value, []).append(value)
    model = train(sample)
    if reject:
        model.levels = levels(sample, model)
    return model


def predict(docs: DataFrame, model: Model, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` with lang_pred and score of every whole text; null texts are ``und``, 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, text_of(text).alias("_text_to_parse"))
    names = rows.columns[:-1]
    schema = StructType(rows.schema.fields[:-1]).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            named, scores, group, size = [], [], [], 0
            for value in each(batch.column(len(names))):
                if group and size + len(value) > CHUNK:
                    for out, more in zip((named, scores), learned.predict(group)):
                        out += more
                    group, size = [], 0
                group.append(value)
                size += len(value)
            if group:
                for out, more in zip((named, scores), learned.predict(group)):
                    out += more
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(named, pa.string()), pa.array(scores, pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    return rows.mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows that teach nothing: crc32 of the key as text leaves 2 of 4. A null key is not one."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
