"""Byte-level BPE encoding and decoding over whole texts.

Encoding looks pieces up in two tiers.  A minimal perfect hash (buckets
with a displacement each, one slot per vocabulary entry) answers every
piece that is a vocabulary entry; the distinct unknown pieces of a batch
are hashed and placed together in numpy.  A miss is merged with a heap of
ranked pairs over a linked list of its bytes, O(n log n) for a piece of
any length.  A worker remembers answers in a table of bounded size.

The vocabulary (a rank file of about 1 MB) is read once by the driver and
broadcast; its size does not depend on the data.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from stratus.llm.hashing import mix64, word_hashes
from stratus.llm.words import slices

# pieces or characters taken at a time, and answers each of a worker's two generations remembers
_PIECES, _CHARACTERS, _MEMO = 100_000, 500_000, 150_000


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary of a rank file (base64 piece and rank per line), by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    vocab = [b""] * len(pairs)
    for piece, rank in pairs:
        vocab[int(rank)] = base64.b64decode(piece)
    return vocab


def _hash_pieces(pieces: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each (not empty) piece."""
    lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
    return word_hashes(np.frombuffer(b"".join(pieces), np.uint8), lens)


class PerfectHash:
    """Piece -> rank for the vocabulary's entries, one slot per entry.

    Keys fall into buckets; larger buckets first, each takes the smallest
    displacement that puts its keys into free slots.  A lookup computes one
    slot and compares the piece there, so strangers are told from entries.
    """

    def __init__(self, vocab: list[bytes]):
        n = len(vocab)
        self.vocab, self.buckets = vocab, max(1, n // 4)
        h = _hash_pieces(vocab)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        self.shift = np.zeros(self.buckets, np.uint64)
        self.rank_at = np.full(n, -1, np.int64)
        for b in np.argsort(-sizes, kind="stable"):
            keys = order[ends[b] - sizes[b] : ends[b]]
            if not len(keys):
                break
            d = 0
            while True:  # a batch of displacements at a time
                tried = np.arange(d, d + 256, dtype=np.uint64)
                slots = self._slot(h[keys][None, :], tried[:, None])
                free = (self.rank_at[slots] < 0).all(axis=1)
                if len(keys) > 1:
                    s = np.sort(slots, axis=1)
                    free &= (s[:, 1:] != s[:, :-1]).all(axis=1)
                if free.any():
                    first = int(np.argmax(free))
                    self.shift[b] = tried[first]
                    self.rank_at[slots[first]] = keys
                    break
                d += 256

    def _slot(self, h: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix64(h + shift * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(len(self.vocab))).astype(np.int64)

    def ranks(self, pieces: list[bytes]) -> list[int]:
        """The rank of each piece, -1 for those outside the vocabulary."""
        h = _hash_pieces(pieces)
        found = self.rank_at[self._slot(h, self.shift[(h % np.uint64(self.buckets)).astype(np.int64)])].tolist()
        vocab = self.vocab
        return [r if vocab[r] == p else -1 for r, p in zip(found, pieces)]


def merge_bytes(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """The ranks that merging the lowest-ranked adjacent pair (leftmost first) ends with."""
    n = len(piece)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    end = list(range(1, n + 1))  # a node holds piece[i:end[i]]
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if end[i] else n
        if j >= n or end[j] != stop:
            continue  # one of the two has been merged since
        end[i], end[j], after[i] = stop, 0, after[j]
        if after[j] < n:
            before[after[j]] = i
            k = after[i]
            if (r := rank_of.get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        k = before[i]
        if k >= 0 and (r := rank_of.get(piece[k:stop])) is not None:
            heapq.heappush(heap, (r, k, stop))
    out, i = [], 0
    while i < n:
        out.append(rank_of[piece[i : end[i]]])
        i = after[i]
    return out


class Codec:
    """Encodes texts to packed ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, table: PerfectHash, pattern: str):
        self.table, self.pattern = table, regex.compile(pattern)
        self.rank_of = {p: r for r, p in enumerate(table.vocab)}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        lens = np.fromiter(map(len, table.vocab), np.int64, len(table.vocab))
        self.lens, self.at = lens, np.cumsum(lens) - lens
        self.bytes = np.frombuffer(b"".join(table.vocab), np.uint8)

    def _learn(self, pieces: set[str]) -> None:
        """Answers the pieces that neither generation of the memo knows, together."""
        memo, older = self.memo, self.older
        new = []
        for p in pieces:
            if (known := older.get(p)) is not None:
                memo[p] = known
            else:
                new.append(p)
        raw = [p.encode("utf-8", "replace") for p in new]
        for p, b, r in zip(new, raw, self.table.ranks(raw)):
            memo[p] = np.array([r] if r >= 0 else merge_bytes(b, self.rank_of), "<u4").tobytes()

    def _pack(self, lists: list[list[str]]) -> list[bytes]:
        pieces = set().union(*lists)
        if unknown := pieces.difference(self.memo):
            if len(self.memo) + len(unknown) > _MEMO:  # a new generation, which needs all of the pieces
                self.older, self.memo, unknown = self.memo, {}, pieces
            self._learn(unknown)
        look_up = self.memo.__getitem__
        return [b"".join(map(look_up, x)) for x in lists]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text.  Texts are taken together up to a number of characters; a longer one in parts."""
        out: list[bytes] = []
        lists: list[list[str]] = []
        held = 0
        for t in texts:
            if t and len(t) > _CHARACTERS:
                out += self._pack(lists)
                lists, held = [], 0
                found = (m.group() for m in self.pattern.finditer(t))
                out.append(b"".join(self._pack([x])[0] for x in iter(lambda: list(islice(found, _PIECES)), [])))
                continue
            lists.append(self.pattern.findall(t) if t else [])
            held += len(t or "")
            if held > _CHARACTERS:
                out += self._pack(lists)
                lists, held = [], 0
        return out + self._pack(lists)

    def decode(self, ids: bytes) -> bytes:
        out = []
        for i in range(0, len(ids), 4 * _PIECES):
            r = np.frombuffer(ids[i : i + 4 * _PIECES], "<u4").astype(np.int64)
            lens = self.lens[r]
            ends = np.cumsum(lens)
            take = np.arange(ends[-1]) + np.repeat(self.at[r] - (ends - lens), lens)
            out.append(self.bytes[take].tobytes())
        return b"".join(out)


_last: Codec | None = None


def _codec(table: PerfectHash, pattern: str) -> Codec:
    """The worker's codec, with what it has learned in earlier tasks."""
    global _last
    if _last is None or _last.table is not table or _last.pattern.pattern != pattern:
        _last = Codec(table, pattern)
    return _last


class Tokenizer:
    """A vocabulary and its perfect hash, broadcast; ``encode`` and ``decode`` are lazy DataFrame steps."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.shared, self.pattern = spark.sparkContext.broadcast(PerfectHash(read_ranks(path))), pattern

    def encode(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id_col``, ids (packed ids, binary) and n_tokens of every text; a null or empty text has no ids.

        Every match of the pattern is encoded separately; special tokens'
        strings are ordinary text.  Rows are kept one for one, other columns
        are left out.
        """
        shared, pattern = self.shared, self.pattern

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = _codec(shared.value, pattern)
            for b in slices(batches):
                ids = codec.encode(b.column(1).to_pylist())
                n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array(n)], [id_col, "ids", "n_tokens"])

        kind = docs.schema[id_col].dataType.simpleString()
        return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, n_tokens long")

    def decode(self, encoded: DataFrame) -> DataFrame:
        """``encoded`` with ``decoded``: the bytes that its packed ``ids`` stand for (null ids: null)."""
        shared, pattern = self.shared, self.pattern
        at = encoded.columns.index("ids")
        names = [*encoded.columns, "decoded"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = _codec(shared.value, pattern)
            for b in slices(batches):
                out = [None if x is None else codec.decode(x) for x in b.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names)

        return encoded.mapInArrow(run, encoded.schema.simpleString()[7:-1] + ",decoded:binary")
