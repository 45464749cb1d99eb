"""Vectorised word and word-window hashing over a block of texts.

A word is ``[^\\x20\\x09-\\x0D]+``. Hashes are 64-bit polynomial sums over
random byte values, so hashes of words and of word windows come from
differences of one cumulative sum: no Python work per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from auditlens.llm.shared import mix, text_bytes

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0xD6E8FEB86659FD93
_WORD_BASE = 0xA0761D6478BD642F
_MASK = (1 << 64) - 1
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 12), base & _MASK, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


class Words:
    """Words of a block: byte spans, bounds per text, 64-bit hashes."""

    def __init__(self, column: pa.Array, lower: bool):
        data, offsets = text_bytes(column)
        if lower:
            data = LOWER[data]
        n = len(data)
        self.data, self.offsets = data, offsets
        solid = ~SPACE[data]
        opens, closes = np.ones(n, bool), np.ones(n, bool)
        opens[1:] = ~solid[:-1]
        closes[:-1] = ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        opens[inner] = True
        closes[inner - 1] = True
        self.starts = np.flatnonzero(solid & opens)
        self.ends = np.flatnonzero(solid & closes) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hashes = self.spans(self.starts, self.ends)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte spans."""
        if not hasattr(self, "_bytes"):
            self._bytes = _sums(_VALUES[self.data] * powers(_BASE, len(self.data)))
        return mix((self._bytes[ends] - self._bytes[starts]) * powers(inverse(_BASE), len(self.data) + 1)[starts])

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``k`` words within one text, and the windows' hashes."""
        ends = np.repeat(self.bounds[1:], self.counts())
        at = np.flatnonzero(np.arange(len(self)) + k <= ends)
        return at, self.sequences(at, at + k)

    def sequences(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of word sequences [first, last)."""
        if not hasattr(self, "_words"):
            self._words = _sums(self.hashes * powers(_WORD_BASE, len(self)))
        return mix((self._words[last] - self._words[first]) * powers(inverse(_WORD_BASE), len(self) + 1)[first])


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text, shingle hash) of a block; a text with fewer than ``k`` words has its whole sequence."""
    counts = words.counts()
    at, hashes = words.windows(k)
    text = words.doc_of_word()[at] if len(at) else np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        text = np.concatenate([text, short])
        hashes = np.concatenate([hashes, words.sequences(words.bounds[short], words.bounds[short + 1])])
        order = np.argsort(text, kind="stable")
        text, hashes = text[order], hashes[order]
    cut = np.searchsorted(text, np.arange(len(counts) + 1))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        hashes[a:b].sort()
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]
