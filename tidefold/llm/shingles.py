"""Word sequences, shingle sets and window hashes of a text as 64-bit numbers."""

from __future__ import annotations

import numpy as np

CACHE_WORDS = 500_000
#: Odd multipliers of a polynomial hash, and of its finisher.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHash(dict):
    """A cache of word -> 64-bit hash that empties itself beyond ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


WORDS = WordHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` consecutive words; a run's hash depends on its words alone.

    Runs double in length until ``n`` is put together from powers of two, so the cost is
    ``log2(n)`` passes, whatever ``n``.
    """
    if len(h) < n:
        return np.zeros(0, np.uint64)
    total, length, power, span = None, 0, h, 1  # power: hashes of runs of ``span`` words
    rest = n
    while True:
        if rest & 1:
            total = power if total is None else mix(total[: len(total) - span] * BASE + power[length:])
            length += span
        rest >>= 1
        if not rest:
            return mix(total ^ np.uint64(n))
        power = mix(power[:-span] * BASE + power[span:])
        span *= 2


def shingle_set(words: list[bytes], n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; of the whole sequence, if it is shorter; empty without words."""
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(run_hashes(word_hashes(words), min(n, len(words))))
