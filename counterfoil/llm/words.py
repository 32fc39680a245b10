"""Words of a text as 64-bit hashes, and hashes of their windows."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def word_hashes(text: str) -> np.ndarray:
    """One hash per word; words are parted by ASCII blanks.

    Hashing a word again takes less time than looking it up, and nothing is kept.
    """
    words = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> _HALF)) * _MIX
    values = (values ^ (values >> _HALF)) * _MIX
    return values ^ (values >> _HALF)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of `size` neighbouring words, by where it starts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for k in range(size):
        found = found * _BASE + words[k : k + n]
    return mixed(found)
