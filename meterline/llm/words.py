"""Words, word hashes and shingles of many texts at once.

A word is a run of bytes other than space and the control characters 9 to 13, which in UTF-8 is the
pattern `[^\\x20\\x09-\\x0D]+`. Words are known by a 64-bit hash: a polynomial over the bytes, taken from
running sums, so that no Python object is made for a word.
"""

from __future__ import annotations

import numpy as np

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 2**64)
#: Bytes that are summed up at a time. Hashes do not depend on it; a worker keeps 16 bytes of powers for each.
_SPAN = 1 << 17
_powers: list[np.ndarray] = []

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, _SPAN + 1)
        _powers[:] = []
        for base in (_BASE, _INVERSE):
            table = np.ones(size, np.uint64)
            table[1:] = np.uint64(base)
            _powers.append(np.multiply.accumulate(table))
    return _powers[0], _powers[1]


def spans(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and the index of each row's first word (one more entry at the end).

    `gaps` tells for each byte whether it parts words.
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~gaps[data]
    left, right = np.ones(n, bool), np.ones(n, bool)
    left[1:] = ~word[:-1]
    right[:-1] = ~word[1:]
    cuts = offsets[:-1][(offsets[:-1] < n) & (offsets[:-1] > 0)]
    left[cuts] = True
    right[cuts - 1] = True
    starts = np.flatnonzero(word & left)
    ends = np.flatnonzero(word & right) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word."""
    out = np.zeros(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        origin = starts[low]
        high = max(int(np.searchsorted(ends, origin + _SPAN, side="right")), low + 1)
        end = int(ends[high - 1])
        power, inverse = _power_tables(end - origin + 1)
        total = np.zeros(end - origin + 1, np.uint64)
        np.cumsum(_BYTE[data[origin:end]] * power[: end - origin], out=total[1:])
        a, b = starts[low:high] - origin, ends[low:high] - origin
        out[low:high] = (total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64) * GOLDEN
        low = high
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 2) -> list[np.ndarray]:
    """For each row its distinct shingles, as sorted hashes.

    A row with fewer words than `width` has one shingle, all its words; a row without words has none.
    """
    lowered = LOWER[data]
    starts, ends, first = spans(lowered, offsets)
    word = hashes(lowered, starts, ends)
    n = len(word)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        rolled = mix(rolled * SECOND + word[k : n - width + 1 + k] + GOLDEN) if len(rolled) else rolled
    out = []
    for i in range(len(offsets) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            short = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                short = mix(short * SECOND + word[k])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
