"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counted for whole Arrow batches in numpy (no loop over
documents' words).  The trees are fitted on a bounded sample of labelled
rows and flattened into three arrays; scoring walks all documents of a
batch down a tree together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import WHITE, free_name, id_digest
from stratus.llm.hashing import long_word_hash, word_hashes
from stratus.llm.words import slices

# Production parameters: labelled rows a model is fitted on at most (smallest id digests first), and its shape
SAMPLE = 20_000
ROUNDS, DEPTH, BINS, RATE, RIDGE, LEAST_WEIGHT = 60, 4, 64, 0.2, 1.0, 1.0
THRESHOLD = 0.3
# bytes counted at a time; a longer text is counted in parts
_PART = 2**19

# one class per byte value: 0 other letters' bytes, then the ASCII classes
_LOWER, _UPPER, _DIGIT, _WHITE, _LINE, _STOP, _COMMA, _BANG, _PIPE, _PUNCT, _CONTROL = range(1, 12)
_CLASS = np.zeros(256, np.uint8)
_CLASS[:128] = _PUNCT
_CLASS[:32] = _CONTROL
_CLASS[127] = _CONTROL
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[9, 11, 12, 13, 32]] = _WHITE
_CLASS[10] = _LINE
_CLASS[ord(".")], _CLASS[ord(",")], _CLASS[ord("!")], _CLASS[ord("|")] = _STOP, _COMMA, _BANG, _PIPE
_CLASSES = 12
# counts per document: the classes, then what is counted over words
_COUNTS = _CLASSES + 8
_ECHO, _DISTINCT = _CLASSES + 4, _CLASSES + 7
_BLANKS = [bytes([c]) for c in (9, 10, 11, 12, 13, 32)]
NAMES = [
    "log_bytes", "log_words", "mean_word", "other", "lower", "upper", "digit", "white", "line", "stop", "comma", "bang",
    "pipe", "punct", "control", "capital_words", "shouted_words", "symbol_words", "echo_words", "short_words", "long_words",
    "distinct_words", "distinct_first",
]


def _counts(data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (documents x _COUNTS) of texts whose bytes stand end to end in ``data``, and the hashes of all words."""
    docs = len(lens)
    out = np.zeros((docs, _COUNTS))
    if not len(data):
        return out, np.zeros(0, np.uint64)
    kind = _CLASS[data]
    doc = np.repeat(np.arange(docs), lens)
    out[:, :_CLASSES] = np.bincount(doc * _CLASSES + kind, minlength=docs * _CLASSES).reshape(docs, _CLASSES)
    inside = (kind != _WHITE) & (kind != _LINE)
    edge = np.zeros(len(data), bool)  # first byte of a document
    edge[(np.cumsum(lens) - lens)[lens > 0]] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | edge))
    if not len(starts):
        return out, np.zeros(0, np.uint64)
    after = np.concatenate([~inside[1:] | edge[1:], [True]])
    size = np.flatnonzero(inside & after) + 1 - starts
    letters, of, first = data[inside], doc[starts], kind[starts]
    ends = np.cumsum(size)
    begin = ends - size
    upper = np.add.reduceat((kind[inside] == _UPPER).astype(np.int64), begin)
    symbol = np.add.reduceat(np.isin(kind[inside], (_PUNCT, _BANG, _PIPE, _CONTROL)).astype(np.int64), begin)
    h = word_hashes(letters, size)
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (of[1:] == of[:-1])])
    key = np.sort(h + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    distinct_at = np.argsort(h + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), kind="stable")
    fresh = np.zeros(len(h), bool)
    fresh[distinct_at[np.concatenate([[True], key[1:] != key[:-1]])]] = True
    for k, hit in enumerate(
        (np.ones(len(h), bool), first == _UPPER, (upper >= 2) & (2 * upper >= size), symbol > 0, same, size <= 3, size >= 12, fresh)
    ):
        out[:, _CLASSES + k] = np.bincount(of[hit], minlength=docs)
    return out, h


def _word_counts(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_counts`` of a text that is one word longer than a part."""
    out = np.zeros((1, _COUNTS))
    for k in range(0, len(word), _PART):
        out[0, :_CLASSES] += np.bincount(_CLASS[word[k : k + _PART]], minlength=_CLASSES)
    upper, symbol = out[0, _UPPER], out[0, [_PUNCT, _BANG, _PIPE, _CONTROL]].sum()
    size = len(word)
    out[0, _CLASSES:] = 1, _CLASS[word[0]] == _UPPER, upper >= 2 and 2 * upper >= size, symbol > 0, 0, size <= 3, size >= 12, 1
    return out, np.array([long_word_hash(word, _PART)])


def _parts(text: bytes) -> Iterator[np.ndarray]:
    """``text`` cut behind white space into parts of ``_PART`` bytes at most; a longer word is a part of its own."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > _PART:
            end = max(text.rfind(c, at, at + _PART) for c in _BLANKS) + 1
            if end <= at:
                blank = re.compile(WHITE.encode()).search(text, at + _PART)
                end = blank.start() if blank else len(text)
        yield np.frombuffer(text, np.uint8, end - at, at)
        at = end


def _long_counts(text: bytes) -> np.ndarray:
    """``_counts`` of one text, in parts."""
    out, last = np.zeros(_COUNTS), np.zeros(0, np.uint64)
    seen, merged = [last], 0
    for part in _parts(text):
        counts, h = _word_counts(part) if len(part) > _PART else _counts(part, np.array([len(part)]))
        out += counts[0]
        out[_ECHO] += len(last) and len(h) and last[0] == h[0]
        last = h[-1:] if len(h) else last
        seen.append(np.unique(h))
        if sum(map(len, seen)) > 2 * merged + _PART:
            seen = [np.unique(np.concatenate(seen))]
            merged = len(seen[0])
    out[_DISTINCT] = len(np.unique(np.concatenate(seen)))
    return out


def features(texts: pa.Array) -> np.ndarray:
    """Statistics (documents x len(NAMES)) of whole texts, the same at any length; a null text counts as empty."""
    raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    counts = np.zeros((len(raw), _COUNTS))
    group: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if group:
            data = np.frombuffer(b"".join(raw[i] for i in group), np.uint8)
            counts[group] = _counts(data, np.array([len(raw[i]) for i in group]))[0]
        group.clear()
        held = 0

    for i, t in enumerate(raw):
        if len(t) > _PART:
            counts[i] = _long_counts(t)
            continue
        if held + len(t) > _PART:
            flush()
        group.append(i)
        held += len(t)
    flush()
    size = counts[:, :_CLASSES].sum(axis=1)
    words = counts[:, _CLASSES]
    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(words, 1)
    inside = size - counts[:, _WHITE] - counts[:, _LINE]
    return np.column_stack(
        [np.log1p(size), np.log1p(words), inside * per_word, counts[:, :_CLASSES] * per_byte[:, None],
         counts[:, _CLASSES + 1 : _CLASSES + 7] * per_word[:, None], counts[:, _CLASSES + 7] * per_word,
         counts[:, _CLASSES + 7] / np.maximum(np.sqrt(words), 1)]
    )


class Forest:
    """Boosted trees as arrays: complete trees of equal depth, node i's children at 2 i + 1 and 2 i + 2."""

    def __init__(self, prior: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray):
        self.prior, self.feature, self.cut, self.leaf = prior, feature, cut, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row of ``x``."""
        rows = np.arange(len(x))
        margin = np.full(len(x), self.prior)
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            margin += leaf[at - inner]
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees on histograms of quantile bins, logistic loss.

    Without rows the score is 1/2; with one label only, it leans to it.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    prior = float(np.log(share / (1 - share)))
    inner = 2**DEPTH - 1
    feature, cut, leaf = np.zeros((ROUNDS, inner), np.int64), np.full((ROUNDS, inner), np.inf), np.zeros((ROUNDS, inner + 1))
    if len(y) == 0 or y.min() == y.max():
        return Forest(prior, feature[:0], cut[:0], leaf[:0])
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
    binned = np.column_stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)])
    columns = np.arange(m) * BINS
    margin = np.full(n, prior)
    for t in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for depth in range(DEPTH):
            low, nodes = 2**depth - 1, 2**depth
            cell = ((at - low)[:, None] * (m * BINS) + columns + binned).ravel()
            shape = (nodes, m, BINS)
            gs = np.bincount(cell, np.repeat(g, m), nodes * m * BINS).reshape(shape).cumsum(axis=2)
            hs = np.bincount(cell, np.repeat(h, m), nodes * m * BINS).reshape(shape).cumsum(axis=2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + RIDGE) + (gt - gs) ** 2 / (ht - hs + RIDGE) - gt**2 / (ht + RIDGE)
            gain[(hs < LEAST_WEIGHT) | (ht - hs < LEAST_WEIGHT)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            split_bin = np.full(nodes, BINS)
            for k in range(nodes):
                j, b = divmod(int(best[k]), BINS)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[t, low + k], cut[t, low + k], split_bin[k] = j, edges[j][b], b
            k = at - low
            at = 2 * at + 1 + (binned[np.arange(n), feature[t, at]] > split_bin[k])
        k = at - inner
        gs, hs = np.bincount(k, g, inner + 1), np.bincount(k, h, inner + 1)
        leaf[t] = -RATE * gs / (hs + RIDGE)
        margin += leaf[t][k]
    return Forest(prior, feature, cut, leaf)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from learning: crc32 of the id's text divides by ``folds``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fits on at most ``sample`` labelled rows outside the held-out fold, in the order of their ids' digests.

    ``labels`` has doc_id and quality; rows whose quality is neither 0 nor
    1, or that have no document, are not used.
    """
    chosen = (
        labels.select("doc_id", "quality")
        .filter(F.col("quality").isin(0, 1) & ~held_out())
        .orderBy(id_digest("doc_id"), "doc_id", "quality")
        .limit(sample)
    )
    # at most `sample` rows of two numbers: bounded by the parameter
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = features(b.column(2))
            vectors = pa.array(list(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), vectors], ["doc_id", "quality", "x"])

    got = (
        rows.mapInArrow(run, rows.schema.simpleString()[7:-1].replace("text:string", "x:array<double>"))
        .orderBy(id_digest("doc_id"), "doc_id", "quality", "x")
        .limit(sample)
        .toArrow()
    )
    if not got.num_rows:
        return fit(np.zeros((0, len(NAMES))), np.zeros(0))
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(got.num_rows, len(NAMES))
    return fit(x, got.column("quality").to_numpy().astype(float))


def score_quality(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of ``docs`` with score (double, 0 to 1) and predicted (int) from the whole text.

    Only the text is read for the score; a null or empty text is scored as
    a text without words.  One row per row of ``docs``; where a carried
    column is called score or predicted, the added one gets an underscore.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    added = [free_name(list(carry), c) for c in ("score", "predicted")]
    names = [*carry, *added]
    text_at = list(carry).index("text") if "text" in carry else len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            score = shared.value.score(features(b.column(text_at)))
            cols = [b.column(i) for i in range(len(carry))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names)

    picked = docs.select(*carry) if "text" in carry else docs.select(*carry, "text")
    fields = ",".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return picked.mapInArrow(run, f"{fields}, {added[0]} double, {added[1]} int")


def score_column(spark: SparkSession, forest: Forest, text: str = "text") -> Column:
    """The score as a column: only the text goes to Python, only the score comes back, and no name is taken."""
    shared = spark.sparkContext.broadcast(forest)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [shared.value.score(features(texts.slice(at, 128))) for at in range(0, len(texts), 128)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(F.col(text))
