"""Words, shingles and their hashes for whole batches of texts, with numpy.

Words are ``[^\\x20\\x09-\\x0D]+``.  Hashes are 64 bits: a polynomial over random
odd byte values modulo 2^64, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: bytes of text that are hashed at once, longer texts aside
CHUNK = 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_random = np.random.Generator(np.random.PCG64(20240229))
BYTE = _random.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
PLACE = _random.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n + (n >> 2), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def chunks(texts: Sequence[bytes], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about size bytes together."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield at, i
            at, held = i, 0
        held += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


class Words:
    """The words of a few texts: ``start`` and ``end`` in ``data``, the text they are ``of``, ``hash``."""

    def __init__(self, texts: Sequence[bytes], lower: bool = False):
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        self.raw = data
        self.data = data = LOWER[data] if lower else data
        self.offset = np.cumsum([0, *[len(t) + 1 for t in texts]])
        word = ~SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.of = np.searchsorted(self.offset, self.start, "right") - 1
        self.n = np.bincount(self.of, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        up, down = _power(len(data) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[data] * up[: len(data)], dtype=np.uint64)))
        self._total, self._down = total, down
        self.hash = self.hash_of(self.start, self.end)

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from start to end."""
        return mix((self._total[end] - self._total[start]) * self._down[start])

    def windows(self, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each run of k words of one text."""
        return runs(self.hash if hashes is None else hashes, self.of, k)


def runs(hashes: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(of[:n] == of[k - 1 :])
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += hashes[j : j + n] * PLACE[j]
    return at, mix(total[at])


def shingle_sets(texts: Sequence[bytes], k: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles, A-Z lower-cased; fewer words make one."""
    for lo, hi in chunks(texts):
        w = Words(texts[lo:hi], lower=True)
        at, h = w.windows(k)
        short = np.flatnonzero((w.n > 0) & (w.n < k))
        one = []
        for i in short:
            own = w.hash[w.first[i] : w.first[i + 1]]
            one.append(mix((own * PLACE[: len(own)]).sum(dtype=np.uint64, keepdims=True) + PLACE[63:] * np.uint64(len(own)))[0])
        of = np.concatenate((w.of[at], short))
        h = np.concatenate((h, np.array(one, np.uint64)))
        order = np.lexsort((h, of))
        of, h = of[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
        of, h = of[new], h[new]
        yield from np.split(h, np.searchsorted(of, np.arange(1, hi - lo)))
