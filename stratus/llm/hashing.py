"""64-bit hashes of words and word sequences, for whole batches in numpy."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9FB21C651E98DF25)
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
_powers = np.ones(1, np.uint64)


def mix64(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word (splitmix64's finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base (modulo 2^64), kept between calls."""
    global _powers
    if len(_powers) < n:
        m = max(n, 2 * len(_powers), 1024)
        p = np.full(m, _BASE, np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers[:n]


def word_hashes(letters: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Hash of each word; ``letters`` are the words' bytes end to end, ``lens`` their (positive) lengths."""
    if not len(lens):
        return np.zeros(0, np.uint64)
    starts = np.cumsum(lens) - lens
    place = np.arange(len(letters)) - np.repeat(starts, lens)
    return mix64(np.add.reduceat(_TABLE[letters] * powers(int(lens.max()))[place], starts) + lens.astype(np.uint64))


def long_word_hash(letters: np.ndarray, part: int) -> np.uint64:
    """``word_hashes`` of one word, ``part`` bytes at a time."""
    total, shift = np.zeros(1, np.uint64), np.ones(1, np.uint64)
    for k in range(0, len(letters), part):
        some = letters[k : k + part]
        total += shift * (_TABLE[some] * powers(len(some))).sum(dtype=np.uint64)
        shift = shift * powers(part + 1)[part:]
    return mix64(total + np.uint64(len(letters)))[0]
