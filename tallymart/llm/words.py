"""Words of many texts at once, as 64-bit hashes, with numpy.

Bytes are enough: every separator is ASCII, so a word ends at the same place in UTF-8 as in code
points. A word's hash is the sum of its bytes' random values times powers of an odd number, modulo
2**64, mixed; prefix sums give it for all words of a step.
"""

from __future__ import annotations

import numpy as np

_SEED = np.random.default_rng(20240101)
_VALUES = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
#: One factor for each place in a shingle.
_PLACES = _SEED.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
LOWER = np.where(_UPPER, _BYTES + 32, _BYTES)
#: Bytes of words that end at white space.
SPACED = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
#: Bytes of words of digits, letters and all beyond ASCII, once A-Z are lower.
ALPHABETIC = (((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | _UPPER
              | (_BYTES >= 128))

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for n places at least."""
    size = 1 << max(16, n.bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for factor in (_BASE, _INVERSE):
            powers = np.full(size, factor, np.uint64)
            powers[0] = 1
            both.append(np.multiply.accumulate(powers))
        _powers[size] = tuple(both)
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, offsets: np.ndarray,
          kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in bytes, and for each text its first word; no word crosses texts."""
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """One hash for each span."""
    powers, inverse = _tables(len(data))
    values = _VALUES[LOWER] if lower else _VALUES
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words; of the whole sequence if it is shorter."""
    if len(words) == 0:
        return words
    n = min(size, len(words))
    total = words[:len(words) - n + 1] * _PLACES[0]
    for place in range(1, n):
        total = total + words[place:len(words) - n + 1 + place] * _PLACES[place]
    return mix(total + np.uint64(n))
