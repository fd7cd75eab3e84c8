"""Hashes of runs of symbols, and local minima of them, for many texts at once in numpy.

A run's hash is a polynomial in an odd base modulo 2^64 over random values of its symbols, taken from
running sums, then mixed.  Modulo a power of two, long rows of few symbols can be arranged to coincide, so words of
more than ``LONG`` bytes take a BLAKE2 digest instead, and runs of words and bytes are of bounded length.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
VALUES = np.random.default_rng(2024).integers(0, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)

#: Bytes that part words.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LONG = 32  # bytes of a word that are hashed by a polynomial


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, base, U), np.full(n, pow(base, -1, 2**64), U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(16, (n - 1).bit_length()), base)
    return up[:n], down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(31))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(29)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(32)
    return h


def running(values: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(len(values), base)[0], out=out[1:], dtype=U)
    return out


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """Hashes of the symbols start to end."""
    return mix((sums[end] - sums[start]) * powers(len(sums), base)[1][start])


def grams(values: np.ndarray, k: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of every k consecutive symbols."""
    if len(values) < k:
        return np.zeros(0, U)
    sums = running(values, base)
    n = len(values) - k + 1
    return mix((sums[k:] - sums[:n]) * powers(n, base)[1])


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of each text (with a last entry for the end)."""
    letter = ~SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    step = np.diff(letter.astype(np.int8))
    cut = np.zeros(len(data), bool)
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True  # a word ends with its text
    begin = np.empty(len(data), bool)
    begin[0] = letter[0]
    begin[1:] = step == 1
    begin |= cut & letter
    stop = np.empty(len(data), bool)
    stop[-1] = letter[-1]
    stop[:-1] = (step == -1) | (cut[1:] & letter[:-1])
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, U)
    out = ranges(running(VALUES[data]), start, end)
    for i in np.flatnonzero(end - start > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the smallest hash (the first of them) of some ``width`` consecutive ones.

    Equal stretches of ``width`` hashes choose the same place.  Works in bounded pieces.
    """
    piece = 1 << 21
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64)
    out = []
    for first in range(0, n - width + 1, piece):
        h = hashes[first : first + piece + width - 1]
        bits = U(22 + (width >> 21))
        coded = (h >> bits << bits) | np.arange(len(h), dtype=U)
        pad = (-len(h)) % width
        rows = np.concatenate([coded, np.full(pad, ~U(0))]).reshape(-1, width)
        head = np.minimum.accumulate(rows, 1).ravel()
        tail = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        count = len(h) - width + 1
        least = np.minimum(tail[:count], head[width - 1 : width - 1 + count])
        chosen = np.zeros(len(h), bool)
        chosen[(least & ((U(1) << bits) - U(1))).astype(np.int64)] = True
        out.append(np.flatnonzero(chosen) + first)
    return np.unique(np.concatenate(out)) if len(out) > 1 else out[0]


def window_minima(values: np.ndarray, k: int, window: int) -> np.ndarray:
    """For every window of one text, the place of the anchor it chooses."""
    hashes, width = grams(values, k), window - k + 1
    count = len(hashes) - width + 1
    if count < 1:
        return np.zeros(0, np.int64)
    places = minima(hashes, width)
    # Of the chosen places in a window, the smallest hash counts, the first of equal ones.
    best = np.full(count, -1, np.int64)
    kept = hashes >> U(22 + (width >> 21)) << U(22 + (width >> 21))
    for p in places.tolist():
        span = np.arange(max(0, p - width + 1), min(count, p + 1))
        old = best[span]
        best[span] = np.where((old < 0) | (kept[p] < kept[old]), p, old)
    return best


def anchors(values: np.ndarray, bounds: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor runs of k symbols: (text number, position within the text, hash).

    Every ``window`` consecutive symbols of a text hold one anchor at least, and equal windows hold equal anchors
    in the same places.  ``bounds`` are the first symbols of the texts, with a last entry for the end.
    """
    hashes = grams(values, k)
    width = window - k + 1
    texts, places, found = [], [], []
    for t in np.flatnonzero(np.diff(bounds) >= window):
        own = hashes[bounds[t] : bounds[t + 1] - k + 1]
        at = minima(own, width)
        texts.append(np.full(len(at), t))
        places.append(at)
        found.append(own[at])
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    return np.concatenate(texts), np.concatenate(places), np.concatenate(found)
