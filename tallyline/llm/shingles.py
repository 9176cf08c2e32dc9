"""Distinct word n-grams of many texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallyline.llm.text_arrays import LOWER, range_hashes, word_bounds

_PLACE = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct shingles of `size` lower-cased words, ascending.

    A text of fewer words has its whole sequence as the only one, a text without words none.
    """
    start, end, firsts = word_bounds(data, bounds)
    words = range_hashes(LOWER[data], start, end)
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        rolled += words[k : k + len(rolled)] * _PLACE[k]
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(32)
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= size:
            found = np.sort(rolled[a : b - size + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif b > a:
            yield (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True) + _PLACE[size + b - a : size + b - a + 1]
        else:
            yield np.zeros(0, np.uint64)
