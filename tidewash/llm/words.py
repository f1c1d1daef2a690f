"""Words and their 64-bit hashes, for whole columns of UTF-8 bytes at once.

A word is a maximal run of word bytes; which bytes count is a 256-entry table, so
the same code serves every word rule that can be told byte by byte.  A-Z count as
a-z.  A word's hash is a polynomial over random byte values modulo 2**64, taken
from prefix sums, then mixed.  Texts never share a word.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20250611)
_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[65:91] = _VALUES[97:123]  # A-Z as a-z
_BASE = int(_RNG.integers(1, 1 << 62)) * 2 + 1
_STEP = 1 << 16
_MASK = (1 << 64) - 1

#: Bytes hashed at once; longer runs of one word extend it.
_BLOCK = 2 << 20


def _powers(base: int) -> tuple[np.ndarray, int]:
    out = np.empty(_STEP, np.uint64)
    p = 1
    for i in range(_STEP):
        out[i] = p
        p = p * base & _MASK
    return out, p


_POW, _POW_STEP = _powers(_BASE)
_INV, _INV_STEP = _powers(pow(_BASE, -1, 1 << 64))


def _power_at(pos: np.ndarray, low: np.ndarray, step: int) -> np.ndarray:
    top = int(pos[-1] >> 16) + 1 if len(pos) else 1
    high = np.empty(top, np.uint64)
    p = 1
    for i in range(top):
        high[i] = p
        p = p * step & _MASK
    return low[pos & (_STEP - 1)] * high[pos >> 16]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(separators: list[tuple[int, int]]) -> np.ndarray:
    """True for word bytes; ``separators`` are inclusive byte ranges."""
    out = np.ones(256, bool)
    for a, b in separators:
        out[a:b + 1] = False
    return out


#: ``[^\x20\x09-\x0D]+``
SPACED = byte_table([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z, so A-Z are word bytes
ALNUM = byte_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word."""
    w = is_word[data]
    prev = np.empty_like(w)
    if len(w):
        prev[0] = False
        prev[1:] = w[:-1]
        starts_at = offsets[:-1][offsets[:-1] < len(data)]
        prev[starts_at] = False
        begin = np.flatnonzero(w & ~prev)
        nxt = np.empty_like(w)
        nxt[-1] = False
        nxt[:-1] = w[1:]
        ends_at = offsets[1:][offsets[1:] > 0] - 1
        nxt[ends_at] = False
        return begin, np.flatnonzero(w & ~nxt) + 1
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are in order and do not overlap."""
    out = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        at = int(begin[i])
        j = max(i + 1, int(np.searchsorted(end, at + _BLOCK, "right")))
        part = data[at:int(end[j - 1])]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUES[part] * _power_at(np.arange(len(part)), _POW, _POW_STEP), out=sums[1:])
        b, e = begin[i:j] - at, end[i:j] - at
        out[i:j] = (sums[e] - sums[b]) * _power_at(b, _INV, _INV_STEP) + (e - b).astype(np.uint64)
        i = j
    return mix(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, begin, end) of every word, and the n + 1 bounds of the texts in them."""
    begin, end = spans(data, offsets, is_word)
    return span_hashes(data, begin, end), begin, end, np.searchsorted(begin, offsets)


_SHINGLE = _RNG.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words (a text with fewer, but not none, has its
    whole sequence as one), and the n + 1 bounds of the texts in them."""
    n = np.diff(bounds)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    total = int(out_bounds[-1])
    if not total:
        return np.zeros(0, np.uint64), out_bounds
    first = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(total)
    length = np.repeat(np.minimum(n, size), counts)
    acc = _SHINGLE[63] * length.astype(np.uint64)
    last = len(hashes) - 1
    for k in range(size):
        term = hashes[np.minimum(first + k, last)] * _SHINGLE[k % 61]
        acc = mix(acc + np.where(k < length, term, np.uint64(0))) if k % 4 == 3 else (
            acc + np.where(k < length, term, np.uint64(0)))
    return mix(acc), out_bounds
