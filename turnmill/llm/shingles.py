"""Word shingles of many texts at once, as 64-bit hashes, in NumPy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

U = np.uint64
CHUNK_BYTES = 1 << 20  # texts handled together; a longer text goes alone

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z like a-z
_BASE = U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Shingler:
    """Distinct shingles of ``k`` words; fewer words are one shingle, no words none."""

    def __init__(self, k: int):
        self.k = k
        self.powers = np.ones(64, np.uint64)
        self._grow(64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n or self.powers[-1] == 1:
            steps = np.full(max(n, 64), _BASE, np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)

    def sets(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """The sorted distinct shingle hashes of every UTF-8 text."""
        group: list[bytes] = []
        size = 0
        for text in texts:
            if group and size + len(text) > CHUNK_BYTES:
                yield from self._sets(group)
                group, size = [], 0
            group.append(text)
            size += len(text) + 1
        if group:
            yield from self._sets(group)

    def _sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        bounds = np.cumsum([len(t) + 1 for t in texts])
        space = _SPACE[data]
        inside = ~space
        starts = np.flatnonzero(inside[1:] & space[:-1]) + 1
        if inside[0]:
            starts = np.concatenate([[0], starts])
        if not len(starts):
            for _ in texts:
                yield np.empty(0, np.uint64)
            return
        ends = np.flatnonzero(space[1:] & inside[:-1]) + 1
        lengths = ends - starts
        self._grow(int(lengths.max()))
        # A word's hash: its bytes weighed by their place in the word.
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        words = np.add.reduceat(_BYTE[data[inside]] * self.powers[place], first)
        words = mix64(words + lengths.astype(np.uint64) * U(0xA24BAED4963EE407))
        k = self.k
        whole = len(words) - k + 1
        if whole > 0:
            joined = words[:whole].copy()
            for i in range(1, k):
                joined = joined * _BASE + words[i : i + whole]
            joined = mix64(joined)
        at = np.searchsorted(starts, bounds)
        begin = 0
        for end in at.tolist():
            n = end - begin
            if n >= k:
                own = np.sort(joined[begin : end - k + 1])
                yield own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif n:
                value = U(n)
                with np.errstate(over="ignore"):
                    for w in words[begin:end]:
                        value = value * _BASE + w
                yield mix64(np.array([value], np.uint64))
            else:
                yield np.empty(0, np.uint64)
            begin = end
