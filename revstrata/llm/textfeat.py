"""Hashed text features as small numpy functions, for use inside tasks."""

from __future__ import annotations

import numpy as np

from revstrata.llm.common import code_points, ship

SPACE = 32
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0x100000001B3)


class Letters:
    """Maps a text to lower-case letters, all else to one space, with a space at either end."""

    def __init__(self) -> None:
        table = np.full(1 << 16, SPACE, dtype=np.uint32)
        for k in range(1 << 16):
            c = chr(k)
            if c.isalpha():
                table[k] = ord(c.lower()[0])
        self.table = table

    def __call__(self, text: str) -> np.ndarray:
        codes = code_points(text)
        if len(codes) and codes.max() >= 1 << 16:
            high = codes >= 1 << 16
            low = self.table[np.where(high, SPACE, codes)]
            far, at = np.unique(codes[high], return_inverse=True)
            low[high] = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else SPACE for c in far], dtype=np.uint32)[at]
            codes = low
        else:
            codes = self.table[codes]
        codes = np.concatenate([[SPACE], codes, [SPACE]]).astype(np.uint32)
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE)
        return codes[keep]


def char_ngrams(letters: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashed identifiers of all character n-grams of the given orders."""
    c = letters.astype(np.uint64)
    shift = np.uint64(64 - bits)
    out = []
    for n in orders:
        if len(c) < n:
            continue
        h = np.full(len(c) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = h * STEP + c[k : len(c) - n + 1 + k]
        out.append((h * MULTIPLIER) >> shift)
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, dtype=np.int64)


def word_features(letters: np.ndarray, prefixes: tuple[int, ...], bits: int) -> np.ndarray:
    """Distinct hashed identifiers of a text's words and of their prefixes of the given lengths."""
    space = letters == SPACE
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    lengths = ends - starts
    c = letters.astype(np.uint64)
    shift = np.uint64(64 - bits)
    longest = int(lengths.max())
    out = []
    h = np.zeros(len(starts), dtype=np.uint64)
    at = np.arange(len(starts))
    for k in range(longest):
        live = lengths[at] > k
        if not live.all():
            at = at[live]
        h[at] = h[at] * STEP + c[starts[at] + k] + np.uint64(1)
        if k + 1 in prefixes:
            out.append(((h[at] ^ np.uint64(k + 1 << 32)) * MULTIPLIER) >> shift)
    out.append((h * MULTIPLIER) >> shift)
    return np.unique(np.concatenate(out)).astype(np.int64)


ship(__name__)
