"""Word shingles as 64-bit numbers, for the operators that compare texts."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_numbers(words: list[bytes] | list[str]) -> np.ndarray:
    """Hashes of the words in UTF-8. To hash a word takes less than to look it up among those met before."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_numbers(words: np.ndarray) -> np.ndarray:
    """A number per window of five words; fewer words are one window, no words none."""
    n = len(words) - SHINGLE + 1
    if n < 1:
        n, words = min(1, len(words)), np.concatenate([words, np.zeros(SHINGLE, dtype=np.uint64)])
    total = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(SHINGLE):
        total += words[k : k + n] * _FACTORS[k]
    return mixed(total)


def text_shingles(text: str) -> np.ndarray:
    """Of the words between the white space U+0020 and U+0009 to U+000D, as written."""
    return shingle_numbers(word_numbers(text.encode().split()))


def counted(shingles: np.ndarray) -> np.ndarray:
    """Sorted numbers in which the k-th occurrence of a shingle is an element of its own.

    The overlap of two multisets is then that of two sets.
    """
    values, counts = np.unique(shingles, return_counts=True)
    out = [values]
    for k in range(1, int(counts.max(initial=1))):
        out.append(mixed(values[counts > k] + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)))
    return np.sort(np.concatenate(out))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if not len(a):
        return 0
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    return int(np.count_nonzero(b[place] == a))


def multiset_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two results of ``counted``; of two empty ones 0."""
    both = overlap(a, b)
    return both / (len(a) + len(b) - both) if both else 0.0
