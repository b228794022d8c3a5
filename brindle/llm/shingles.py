"""Words, word hashes and five-word shingles as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word [^\\x20\\x09-\\x0D]+ of a text."""
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` consecutive words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for i in range(1, width):
        out *= ODD
        out += words[i : i + n]
    return mix(out)


def shingles(words: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles, sorted, and how often each stands; of a shorter text, all its words."""
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(grams(words, min(width, len(words))), return_counts=True)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct hashes."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)
