"""Words of whole batches of texts, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from stratus.llm.hashing import word_hashes

# White space between words; A-Z are lower-cased
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


def folded_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased): the hash, the text's number, and the first byte's place in all."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    lens = np.array([len(t) for t in texts], np.int64)
    none = np.zeros(0, np.int64)
    if not len(data):
        return np.zeros(0, np.uint64), none, none
    inside = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)  # a text begins here
    edge[(np.cumsum(lens) - lens)[lens > 0]] = True
    edge[-1] = True
    starts = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:-1]))
    if not len(starts):
        return np.zeros(0, np.uint64), none, none
    ends = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | edge[1:])) + 1
    of = np.searchsorted(np.cumsum(lens), starts, side="right")
    return word_hashes(_FOLD[data[inside]], ends - starts), of, starts


def slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows: a task holds the texts of one part as Python objects, not of a whole batch."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def groups(texts: list[bytes], most: int = 2**19) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``most`` bytes together (a longer text alone) and the first one's number."""
    at = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield at, texts[at:i]
            at, held = i, 0
        held += len(t)
    if at < len(texts):
        yield at, texts[at:]
