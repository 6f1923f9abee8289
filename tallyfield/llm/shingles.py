"""Distinct 5-word shingles of whole texts as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5

# Odd multipliers of a word's place in a shingle, from a fixed seed.
_PLACE = np.random.default_rng(20240501).integers(0, 1 << 63, 2 * WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Words are cut at ASCII white space and A-Z lower-cased; fewer than five make one shingle."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    if n < WORDS:
        return mixed((hashes * _PLACE[WORDS : WORDS + n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    total = np.zeros(n - WORDS + 1, np.uint64)
    for place in range(WORDS):
        total += hashes[place : n - WORDS + 1 + place] * _PLACE[place]
    return np.unique(mixed(total))
