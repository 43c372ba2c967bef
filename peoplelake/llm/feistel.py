"""A keyed permutation of 0 .. n-1 that any row computes for itself: Feistel rounds with cycle walking.

Numpy for Spark tasks. All products stay below 2**62.
"""

from __future__ import annotations

import numpy as np

ROUNDS = 6
#: Odd multipliers of the round function, fixed values.
FIRST, SECOND, TWEAK = 1540483477, 1812433253, 1664525
LOW = (1 << 31) - 1


def round_keys(seed: int) -> list[int]:
    """One 31-bit key per round, by a linear congruence from the seed."""
    keys, state = [], seed & LOW
    for _ in range(ROUNDS):
        state = (state * 1103515245 + 12345) & LOW
        keys.append(state)
    return keys


def half_bits(n):
    """Bits of half a word, so that 4**bits >= n; at least 1. Integers or integer arrays below 2**62."""
    n = np.asarray(n, dtype=np.int64)
    bits = np.ones_like(n)
    for b in range(1, 31):
        bits = np.where(n > (np.int64(1) << np.int64(2 * b)), b + 1, bits)
    return bits


def _mix(x, key: int, tweak, mask):
    h = ((x + key + tweak * TWEAK) & LOW) * FIRST
    h = h ^ (h >> 15)
    h = (h & LOW) * SECOND + key
    return (h ^ (h >> 13)) & mask


def _rounds(v, bits, keys, tweak, forward: bool):
    mask = (np.int64(1) << bits) - 1
    left, right = v >> bits, v & mask
    for key in keys if forward else reversed(keys):
        if forward:
            left, right = right, left ^ _mix(right, key, tweak, mask)
        else:
            left, right = right ^ _mix(left, key, tweak, mask), left
    return (left << bits) | right


def permute(x, n, seed: int, tweak=0, forward: bool = True) -> np.ndarray:
    """Place of each ``x`` in 0 .. n-1; ``forward=False`` inverts. ``n`` and ``tweak`` are scalars or arrays like ``x``.

    A value that falls outside is fed through the rounds again until it is inside, so the map stays one to one.
    """
    x = np.atleast_1d(np.array(x, dtype=np.int64))
    n = np.broadcast_to(np.asarray(n, dtype=np.int64), x.shape)
    tweak = np.broadcast_to(np.asarray(tweak, dtype=np.int64) & LOW, x.shape)
    if ((x < 0) | (x >= n)).any():
        raise ValueError("values must lie in 0 .. n-1")
    bits, keys = half_bits(n), round_keys(seed)
    out = _rounds(x, bits, keys, tweak, forward)
    while (outside := np.flatnonzero(out >= n)).size:
        out[outside] = _rounds(out[outside], bits[outside], keys, tweak[outside], forward)
    return out
