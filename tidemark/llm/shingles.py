"""Sets of five-word shingles as sorted 64-bit hashes, for work inside tasks."""

from __future__ import annotations

import numpy as np

WORDS = 5
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if len(_powers[0]) < n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            _powers[k] = np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, base, np.uint64)))
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of each word of a UTF-8 text, A-Z taken as a-z."""
    if not data:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    space = SPACE[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=total[1:])
    return begin, end, mix((total[end] - total[begin]) * inverse[begin])


def shingle_hashes(data: bytes) -> np.ndarray:
    """Hashes of all runs of five words, in the order of the text; fewer words are one shingle."""
    return runs_of_words(word_spans(data)[2])


def runs_of_words(words: np.ndarray) -> np.ndarray:
    if not len(words):
        return words
    size = min(WORDS, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(_BASE) + words[k : k + n])
    return h


def shingle_set(data: bytes) -> np.ndarray:
    h = np.sort(shingle_hashes(data))
    return h[np.append(True, h[1:] != h[:-1])] if len(h) else h
