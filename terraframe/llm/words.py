"""Words of long texts as hashes, in numpy, for use inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

BLOCK_BYTES = 1 << 20
CACHED_WORDS = 1 << 19
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
# An odd base, its inverse modulo 2**64 and a finishing factor of the rolling hash.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_FINISH = np.uint64(0xFF51AFD7ED558CCD)


def word_blocks(text: str | None, lower: bool) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, some at a time; A-Z in lower case if wanted."""
    data = (text or "").encode()
    start = 0
    while start < len(data):
        stop = start + BLOCK_BYTES
        if stop < len(data):
            cut = _SPACE.search(data, stop)
            stop = cut.start() if cut else len(data)
        block = data[start:stop]
        yield (block.lower() if lower else block).split()
        start = stop


class WordHashes:
    """64-bit hashes of words, remembered up to a fixed number of words."""

    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}

    def of(self, text: str | None, lower: bool) -> np.ndarray:
        parts = []
        for words in word_blocks(text, lower):
            known = self._known
            if len(known) > CACHED_WORDS:
                known.clear()
            for w in set(words).difference(known):
                known[w] = xxhash.xxh3_64_intdigest(w)
            parts.append(np.array([known[w] for w in words], dtype=np.uint64))
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; none if there are fewer words."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    up, down = _grown(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:n], dtype=np.uint64)])
    out = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    out ^= out >> np.uint64(32)
    out *= _FINISH
    return out ^ (out >> np.uint64(29))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """As grams, but a text of fewer than k words counts as one shingle; no words, no shingles."""
    return grams(hashes, min(k, len(hashes))) if len(hashes) else np.empty(0, np.uint64)
