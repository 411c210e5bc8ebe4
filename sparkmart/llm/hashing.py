"""Word positions and 64-bit word hashes of whole Arrow text batches, without a loop over words.

Words are maximal runs of other bytes than space, tab, line feed, vertical tab, form feed and
carriage return; ASCII letters count in lower case.  A word's hash is a keyed polynomial of its
bytes modulo 2**64, read off a running sum, so the cost per byte is that of a few array passes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PIECE = 1 << 20
U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_random = np.random.default_rng(20240503)
BYTE_KEY = _random.integers(1, 2 ** 63, 256, dtype=np.uint64)
BYTE_KEY[65:91] = BYTE_KEY[97:123]
BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse for i up to ``n``, modulo 2**64."""
    size = 1 << max(12, int(n).bit_length())
    if (base, size) not in _tables:
        _tables[base, size] = tuple(
            np.cumprod(np.r_[U(1), np.full(size - 1, b, U)], dtype=np.uint64)
            for b in (U(base), U(pow(base, -1, 2 ** 64))))
    return _tables[base, size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of hashes (the finaliser of splitmix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@dataclass
class Words:
    """Words of a batch: byte ranges, hashes, the row of each word, and each row's first word."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    row: np.ndarray
    first: np.ndarray


def words(buf: np.ndarray, offs: np.ndarray) -> Words:
    """Words of all rows; works through pieces of about 1 MB, so memory doesn't grow with a text."""
    fresh = np.zeros(len(buf) + 1, bool)
    fresh[offs] = True
    starts, ends, hashes, a = [], [], [], 0
    while a < len(buf):
        b = min(a + PIECE, len(buf))
        while b < len(buf) and not (SPACE[buf[b]] or fresh[b]):  # never cut a word
            step = np.flatnonzero(SPACE[buf[b:b + PIECE]] | fresh[b:min(b + PIECE, len(buf))])
            b = b + int(step[0]) if len(step) else min(b + PIECE, len(buf))
        part = buf[a:b]
        black = ~SPACE[part]
        begins = black.copy()
        begins[1:] &= ~black[:-1] | fresh[a + 1:b]
        stops = black.copy()
        stops[:-1] &= ~black[1:] | fresh[a + 1:b]
        s, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        up, down = powers(BASE, len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE_KEY[part] * up[:len(part)], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
        starts.append(s + a)
        ends.append(e + a)
        a = b
    none = np.empty(0, np.int64)
    start = np.concatenate(starts or [none])
    first = np.searchsorted(start, offs)
    return Words(start, np.concatenate(ends or [none]),
                 np.concatenate(hashes or [none.astype(np.uint64)]),
                 np.repeat(np.arange(len(offs) - 1), np.diff(first)), first)


def range_hash(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of each run of words ``[lo, hi)``; equal word runs have equal hashes."""
    up, down = powers(WORD_BASE, len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=total[1:])
    return mix((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def shingles(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every ``size``-word run; the whole sequence of rows with fewer words."""
    left = np.repeat(w.first[1:], np.diff(w.first)) - np.arange(len(w.hash))
    count = np.repeat(np.diff(w.first), np.diff(w.first))
    lead = np.arange(len(w.hash)) == np.repeat(w.first[:-1], np.diff(w.first))
    at = np.flatnonzero((left >= size) | (lead & (count < size)))
    return range_hash(w.hash, at, at + np.minimum(size, left[at])), at
