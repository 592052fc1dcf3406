"""Sets of word shingles as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words in a shingle.
WORDS = 5
#: Words whose hashes a worker keeps.
KEPT = 100_000
_known: dict[bytes, int] = {}
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    new = [w for w in set(words) if w not in _known]  # subtracting the keys would walk over all of them
    if len(_known) + len(new) > KEPT:
        _known.clear()
        new = list(set(words))
    _known.update((w, xxhash.xxh3_64_intdigest(w) - (1 << 63)) for w in new)
    return np.fromiter(map(_known.__getitem__, words), np.int64, len(words)).view(np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles: A-Z in lower case, words
    parted by the ASCII white space characters; under WORDS words, all of
    them as one shingle; none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    k = min(WORDS, len(h))
    s = h[: len(h) - k + 1].copy()
    for j in range(1, k):
        s = mixed(s * _ODD + h[j : len(h) - k + 1 + j])
    return np.unique(s if k == WORDS else mixed(s + np.uint64(k)))
