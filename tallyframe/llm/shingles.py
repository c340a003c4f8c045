"""Shingle sets of texts as sorted 64-bit hashes, and MinHash keys of them."""

from __future__ import annotations

import numpy as np
import xxhash

from tallyframe.llm.common import ascii_lower, words

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of ``size``-word shingles; A-Z count as a-z. A text with fewer words is one shingle, one without none."""

    def __init__(self, size: int, most_cached: int = 100_000):
        self.size, self.most_cached = size, most_cached
        self.hashes: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        found = self.hashes.get(word)
        if found is None:
            if len(self.hashes) >= self.most_cached:
                self.hashes.clear()
            found = self.hashes[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def set_of(self, text: str | None) -> np.ndarray:
        tokens = words(ascii_lower(text)) if text else []
        if not tokens:
            return np.empty(0, dtype=np.uint64)
        hashed = np.fromiter(map(self._hash, tokens), dtype=np.uint64, count=len(tokens))
        size = min(self.size, len(tokens))
        rolled = np.zeros(len(tokens) - size + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(size):
                rolled = rolled * _PRIME + hashed[i : i + len(rolled)]
            return np.unique(_mixed(rolled + np.uint64(size)))


def same_set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that are equal for equal sets."""
    digest = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), dtype=np.int64)
    return int(digest[0]), int(digest[1])


class Bands:
    """Two small collections of ``collection`` bands with ``rows`` minhashes each.

    Table keys are all pairs of a band of the one and a band of the other: ``collection`` squared tables of
    2 * ``rows`` minhashes from only 2 * ``collection`` * ``rows`` minhashes.
    """

    def __init__(self, collection: int, rows: int, seed: int = 11):
        random = np.random.default_rng(seed)
        self.rows = rows
        n = 2 * collection * rows
        self.factor = random.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = random.integers(0, 1 << 63, n, dtype=np.uint64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """One key per band, the first collection first, as signed numbers."""
        with np.errstate(over="ignore"):
            least = np.array([(hashes * a + b).min() for a, b in zip(self.factor, self.shift)], dtype=np.uint64)
            keys = np.zeros(len(least) // self.rows, dtype=np.uint64)
            for column in least.reshape(-1, self.rows).T:
                keys = _mixed(keys * _PRIME + column)
        return keys.view(np.int64)
