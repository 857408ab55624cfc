"""Hashed byte n-grams of many texts at once, and linear models on them."""

from __future__ import annotations

import numpy as np

_BYTES = np.arange(256)
#: A-Z as a-z; other ASCII but a-z as a space; all beyond ASCII as it is.
_LETTERS = np.where(
    (_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32,
    np.where(((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128), _BYTES, 32)).astype(np.uint8)


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes in lower case, Latin-1 letters too, with a space for each ASCII byte but a letter."""
    out = _LETTERS[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    upper = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[upper] += 0x20
    return out


def hashed(data: np.ndarray, offsets: np.ndarray, order: int, bits: int) -> np.ndarray:
    """A bucket for the n-gram at each byte; 2**bits where it would leave its text."""
    out = np.full(len(data), 1 << bits, np.int64)
    if len(data) < order:
        return out
    grams = data[:len(data) - order + 1].astype(np.uint64)
    for place in range(1, order):
        grams = (grams << np.uint64(8)) | data[place:len(data) - order + 1 + place]
    grams = (grams + np.uint64(order << 56)) * np.uint64(0x9E3779B97F4A7C15)
    out[:len(grams)] = grams >> np.uint64(64 - bits)
    for back in range(1, order):  # those that reach past the end of their text
        at = offsets[1:] - back
        out[at[at >= offsets[:-1]]] = 1 << bits
    return out


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` for each text."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, dtype=np.float64, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def descend(loss, size: int, rounds: int, step: float) -> np.ndarray:
    """Accelerated gradient steps from 0 on ``loss``, which gives the gradient."""
    x = y = np.zeros(size)
    t = 1.0
    for _ in range(rounds):
        new = y - step * loss(y)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = new, new + (t - 1) / t_new * (new - x), t_new
    return x
