"""Hashed word shingles of texts, in NumPy."""

from __future__ import annotations

import numpy as np
import xxhash

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text: str) -> list[bytes]:
    """Words of a text between ASCII white space, with A-Z in lower case."""
    return text.encode().translate(_LOWER).split()


def mixed(values: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(text: str, length: int) -> np.ndarray:
    """64-bit hashes of all runs of ``length`` words, in order; of fewer words, the whole as one."""
    own = words(text)
    if not own:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    width = min(length, len(own))
    joined = np.full(len(own) - width + 1, width, np.uint64)
    for i in range(width):
        joined = joined * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(own) - width + 1 + i]
        joined ^= joined >> np.uint64(32)
    return mixed(joined)
