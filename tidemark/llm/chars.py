"""Characters of a text as small integers, and their q-grams packed into 64-bit numbers, for work inside tasks."""

from __future__ import annotations

import numpy as np


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def ascii_lower(points: np.ndarray) -> np.ndarray:
    return np.where((points >= 65) & (points <= 90), points + 32, points)


def fold(points: np.ndarray) -> np.ndarray:
    """One byte per character; equal characters have equal bytes, different ones rarely do."""
    return (points ^ (points >> 8) ^ (points >> 16)).astype(np.uint8)


def grams(bytes_: np.ndarray, q: int) -> np.ndarray:
    """All windows of ``q`` <= 8 bytes as numbers, one for each start."""
    n = len(bytes_) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    padded = np.concatenate([bytes_, np.zeros(8, np.uint8)])
    words = np.ndarray((n,), "<u8", padded.data, 0, (1,))
    return words & np.uint64((1 << 8 * q) - 1) if q < 8 else words.copy()


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """Multiplicative hash to ``bits`` bits."""
    mixed = keys * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)
