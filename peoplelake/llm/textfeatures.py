"""Hashed character n-grams of whole texts as numpy arrays, for use inside Spark tasks."""

from __future__ import annotations

import numpy as np

_PRIME = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_LETTER: list[np.ndarray] = []


def points(text: str) -> np.ndarray:
    """Code points; a lone surrogate, which UTF-8 can't hold, passes as it is."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def letters(text: str) -> np.ndarray:
    """Lower-case letters as code points, each stretch of anything else as one blank, with a blank at either end."""
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    found = points(f" {text.lower()} ")
    is_letter = _LETTER[0][found]
    keep = is_letter.copy()
    keep[0] = True
    keep[1:] |= is_letter[:-1]
    return np.where(is_letter, found, 32)[keep]


def ngrams(found: np.ndarray, shortest: int, longest: int, bits: int) -> np.ndarray:
    """Hashes, below 2**bits, of all n-grams of these lengths, repeats included."""
    wide = found.astype(np.uint64) + np.uint64(1)
    rolling, parts = wide, []
    for n in range(1, min(longest, len(wide)) + 1):
        if n > 1:
            rolling = rolling[:-1] * _PRIME + wide[n - 1:]
        if n >= shortest:
            parts.append(((rolling + np.uint64(n)) * _SPREAD) >> np.uint64(64 - bits))
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
