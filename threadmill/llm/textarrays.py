"""Texts as numpy arrays inside tasks: code points, word hashes, shingles, minima of hashes.

All hashes are 64-bit and the same on every machine. Arithmetic wraps around on purpose.
"""

from __future__ import annotations

from functools import cache

import numpy as np

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_C = np.uint64(0xFF51AFD7ED558CCD)
_POWERS = 1 << 16
_COLUMNS = 1 << 10
_CODE_POINTS = 0x110000


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the input reaches every bit of the output."""
    h = h ^ (h >> np.uint64(33))
    h = h * _C
    h = h ^ (h >> np.uint64(29))
    h = h * _B
    return h ^ (h >> np.uint64(32))


@cache
def _powers() -> np.ndarray:
    out = np.full(_POWERS, _A, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@cache
def letter_table() -> np.ndarray:
    """True for every code point that is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(_CODE_POINTS)), bool, _CODE_POINTS)


@cache
def word_table() -> np.ndarray:
    """True for letters, numbers and the underscore."""
    return np.fromiter((chr(i).isalnum() or i == 95 for i in range(_CODE_POINTS)), bool, _CODE_POINTS)


@cache
def space_table() -> np.ndarray:
    return np.fromiter((chr(i).isspace() for i in range(_CODE_POINTS)), bool, _CODE_POINTS)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and ends of the runs of True."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate([[0] if inside[0] else [], change, [len(inside)] if inside[-1] else []]).astype(np.int64)
    return edges[::2], edges[1::2]


def word_hashes(points: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """One hash per run of code points that ``inside`` marks, in order."""
    starts, ends = runs(inside)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.flatnonzero(inside)
    first = np.repeat(starts, lengths)
    terms = (points[at].astype(np.uint64) + np.uint64(1)) * _powers()[(at - first) % _POWERS]
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return mixed(np.add.reduceat(terms, offsets) + lengths.astype(np.uint64))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of ``n`` successive words; of all words where there are fewer."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = min(n, len(words))
    m = len(words) - n + 1
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = h * _A + words[i : i + m]
    return np.unique(mixed(h))


def text_shingles(text: str | None, n: int) -> np.ndarray:
    """Shingles of the lower-cased words of a text; none for null and for texts without words."""
    if not text:
        return np.zeros(0, np.uint64)
    points = code_points(text.lower())
    return shingles(word_hashes(points, word_table()[points]), n)


@cache
def _multipliers(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _A) | np.uint64(1)


def minima(hashes: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` hash functions the least value over a non-empty set, 32 bits each."""
    out = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    by_function = _multipliers(n)[:, None]
    for begin in range(0, len(hashes), _COLUMNS):
        np.minimum(out, (by_function * hashes[begin : begin + _COLUMNS]).min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """Two numbers that two sets share only if they are equal, up to 128-bit chance."""
    if not len(hashes):
        return 0, 0
    total = np.add.reduce(mixed(hashes))
    other = np.bitwise_xor.reduce(mixed(hashes + _B)) + np.uint64(len(hashes))
    return int(total.astype(np.int64)), int(other.astype(np.int64))
