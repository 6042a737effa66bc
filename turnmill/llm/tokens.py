"""Ids of a public tokenizer's file, with a cache of words in every Python worker."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from turnmill.llm.common import slices

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
CACHED = 120_000  # words in each of two generations that a worker remembers
PART = 1 << 20  # characters of a text that are split together

#: Characters whose normal form and lower case are themselves or one known letter, and white space.
PLAIN = re.compile("[\t-\r !-~À-ÖØ-öø-ÿ]*")
#: The file's own split pattern, for plain characters; white space is dropped.
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\t-\r ]+")


def byte_letters() -> dict[int, str]:
    """The letter a byte-level model uses for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in own}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(own))
    return letters


class Remembered(dict):
    """Ids of words, computed once; what is in use outlives a full table."""

    def __init__(self, compute: Callable[[str], bytes]):
        super().__init__()
        self.compute = compute
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.compute(word)
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class WordTokenizer:
    """Text to ids, as little-endian bytes.

    The file drops white space and never joins across it, so the ids of a part between
    two blanks do not depend on its neighbours. A part of plain characters is split into
    words here and each word's ids are remembered; any other goes through the whole
    tokenizer, chunk by chunk between white space.
    """

    def __init__(self, path: str, dtype: str = "<u4", specials_are_text: bool = False):
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = specials_are_text
        self.bpe = self.model.model
        self.dtype = dtype
        self.letters = {chr(b): x for b, x in byte_letters().items()}
        self.each: list[bytes] = [self._pack([i]) for i in range(self.model.get_vocab_size())]
        self.words = Remembered(self._word)
        self.chunks = Remembered(self._chunk)

    def _word(self, word: str) -> bytes:
        spelt = word if word.isascii() else "".join([self.letters[c] for c in word.encode().decode("latin-1")])
        each = self.each
        return b"".join([each[t.id] for t in self.bpe.tokenize(spelt)])

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if "<|" not in chunk and PLAIN.fullmatch(chunk):
            return b"".join(map(self.words.__getitem__, SPLIT.findall(chunk.lower())))
        return self._pack(self.model.encode(chunk, add_special_tokens=False).ids)

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def ids(self, text: str) -> bytes:
        out = []
        for start, end in slices(text, PART):
            part = text[start:end]
            if "<|" not in part and PLAIN.fullmatch(part):
                out.append(b"".join(map(self.words.__getitem__, SPLIT.findall(part.lower()))))
                continue
            for c in "\n\t\r\x0b\x0c":
                if c in part:
                    part = part.replace(c, " ")
            out.append(b"".join(map(self.chunks.__getitem__, part.split(" "))))
        return b"".join(out)


_held: dict[tuple, WordTokenizer] = {}


def tokenizer(path: str, dtype: str = "<u4", specials_are_text: bool = False) -> WordTokenizer:
    """This worker's tokenizer for a file; its cache outlives a task."""
    key = (path, dtype, specials_are_text)
    if key not in _held:
        _held[key] = WordTokenizer(*key)
    return _held[key]
