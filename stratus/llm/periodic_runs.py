"""Runs: maximal stretches of words that repeat with a period, by tiles per period octave.

Octave P covers the periods P to 2P - 1.  A document is cut into tiles for
each octave: a core of boundaries, the multiples of P, with 2P words before
and 6P words behind, so neighbouring tiles overlap by more than four
periods.  Tiles are solved independently of each other: at a boundary, a
Z-function of the words behind it gives for every period how far the words
keep repeating, and one of the reversed words before it how far they did.
What is found is a fragment, cut off at the edge of the boundary's tile.
Fragments are shuffled by document and period; those of one run overlap by
a period at least, and are stitched to the whole run.

Most tiles hold no run.  A run of four periods or more holds, within P
words of its start, a boundary whose next 2P words occur again, for the
first time, q words later (a window longer than a primitive period occurs
only at multiples of it).  Windows of 1, 2, 4, ... words are numbered by
sorting pairs of numbers of half the length, so equal numbers are equal
words, without hashing; windows that do not occur twice are not looked at
for longer ones.  Only boundaries that pass make tiles, and only tiles,
with their words as numbers, are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import written
from stratus.llm.words import groups, slices

# Production parameters: least number of periods and of words of a run
PERIODS, LEAST = 4, 6
# words before and behind a boundary, in units of its octave; boundaries of one tile; every how many boundaries of a stretch are solved
_BEFORE, _BEHIND, _CORE, _EVERY = 2, 6, 256, 4
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")

TILE = "octave: int, start: bigint, boundaries: array<int>, words: array<int>"
RUN = "start: bigint, length: bigint, period: bigint"


def number_words(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text; the number of every word of all texts, end to end, and each text's first place.

    Behind every text stands a number of its own, so no repeat crosses a text's end.
    """
    words = [_WORD.findall(t) for t in texts]
    of: dict[bytes, int] = {}
    numbers: list[int] = []
    first = np.zeros(len(texts) + 1, np.int64)
    for i, w in enumerate(words):
        numbers += [of.setdefault(x, len(of)) for x in w]
        numbers.append(-1 - i)
        first[i + 1] = len(numbers)
    out = np.array(numbers, np.int64)
    out[out < 0] = len(of) - 1 - out[out < 0]
    return words, out, first


def _numbered(places: np.ndarray, a: np.ndarray, b: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places whose pair (a, b) occurs twice or more: places in order, the pair's number, and the next equal pair's place (or -1).

    All items are smaller than ``top``.
    """
    bits = top.bit_length()
    if 3 * bits <= 63:  # one sort of single integers
        key = np.sort(((a << bits | b) << bits) | places)
        p = key & ((1 << bits) - 1)
        pair = key >> bits
        same = pair[1:] == pair[:-1]
    else:
        order = np.lexsort((places, b, a))
        p, a, b = places[order], a[order], b[order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    number = np.cumsum(np.concatenate([[True], ~same])) - 1
    after = np.concatenate([np.where(same, p[1:], -1), [-1]])
    p, number, after = p[twice], number[twice], after[twice]
    back = np.argsort(p)
    return p[back], number[back], after[back]


def passing_boundaries(numbers: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per octave P: text, place in the text, and distance of the boundaries whose next 2P words recur P to 2P - 1 words later."""
    top = len(numbers)
    if not top:
        return
    places, number, after = _numbered(np.arange(top), numbers, np.zeros(top, np.int64), top)
    octave, length = 1, 1  # windows of `length` words are numbered
    longest = int(np.diff(first).max()) - 1
    while PERIODS * octave <= longest and len(places):
        # windows of twice the length: both halves must occur twice
        slot = np.full(top + length, -1)
        slot[places] = np.arange(len(places))
        right = slot[places + length]
        both = right >= 0
        if not both.any():
            return
        places, number, after = _numbered(places[both], number[both], number[right[both]], top)
        length *= 2
        gap = after - places
        text = np.searchsorted(first, places, side="right") - 1
        inside = places - first[text]
        hit = (gap >= octave) & (gap < 2 * octave) & (inside % octave == 0)
        if hit.any():
            yield octave, text[hit], inside[hit], gap[hit]
        octave *= 2


def thinned(text: np.ndarray, inside: np.ndarray, gap: np.ndarray, octave: int) -> np.ndarray:
    """Of each stretch of neighbouring boundaries with one distance: the first, every fourth, and the last."""
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(inside) != octave) | (np.diff(gap) != 0)
    starts = np.flatnonzero(new)
    rank = np.arange(len(text)) - np.repeat(starts, np.diff(np.append(starts, len(text))))
    return new | (rank % _EVERY == 0) | np.append(new[1:], True)


def tiles_of(numbers: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, dict]]:
    """The text's number and the tile, for every tile that holds a passing boundary."""
    for octave, text, inside, gap in passing_boundaries(numbers, first):
        keep = thinned(text, inside, gap, octave)
        text, inside = text[keep], inside[keep]
        tile = inside // (octave * _CORE)
        new = np.ones(len(text), bool)
        new[1:] = (np.diff(text) != 0) | (np.diff(tile) != 0)
        starts = np.flatnonzero(new)
        for lo, hi in zip(starts, np.append(starts[1:], len(text))):
            t = int(text[lo])
            end = int(first[t + 1] - first[t]) - 1
            begin = max(0, int(inside[lo]) - _BEFORE * octave)
            stop = min(end, int(inside[hi - 1]) + _BEHIND * octave)
            words = numbers[first[t] + begin : first[t] + stop].astype(np.int32)
            yield t, {"octave": octave, "start": begin, "boundaries": inside[lo:hi] - begin, "words": words}


def z_function(x: list[int]) -> list[int]:
    """For every place, how many items from there on equal the first ones."""
    n = len(x)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _primitive(words: list[int], period: int) -> bool:
    """Whether words of this period (two of it at least) have no smaller one that divides it."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            p = period // factor
            if words[p:] == words[:-p]:
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def fragments(octave: int, boundaries: list[int], words: list[int], start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(period, from, to) of what the tile's boundaries show, with places counted in the document.

    ``end`` is the document's length: a fragment at the tile's edge may go
    on there, unless it is the document's.
    """
    n = len(words)
    for c in boundaries:
        lo, hi = max(0, c - _BEFORE * octave), min(n, c + _BEHIND * octave)
        forward = z_function(words[c:hi])
        before = words[lo:c][::-1]
        backward = z_function([*before, -1, *words[lo : min(hi, c + 2 * octave)][::-1]])
        top = len(before) + 1 + min(hi, c + 2 * octave) - c  # where the reversed words before the boundary start
        for q in range(octave, min(2 * octave, hi - c)):
            ahead = forward[q]
            back = backward[top - q] if before else 0
            begin, stop = c - back, c + q + ahead
            open_ended = (begin == lo and start + begin > 0) or (stop == hi and start + stop < end)
            length = stop - begin
            if length >= PERIODS * q or (open_ended and length >= 2 * q):
                if _primitive(words[begin:stop], q):
                    yield q, start + begin, start + stop


_ARROW_TILE = pa.struct(
    [("octave", pa.int32()), ("start", pa.int64()), ("boundaries", pa.list_(pa.int32())), ("words", pa.list_(pa.int32()))]
)


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        texts = [x or b"" for x in b.column(1).cast(pa.binary()).to_pylist()]
        for at, some in groups(texts):
            words, numbers, first = number_words(some)
            tiles: list[list[dict]] = [[] for _ in some]
            for t, tile in tiles_of(numbers, first):
                tiles[t].append(tile)
            columns = [
                b.column(0).slice(at, len(some)),
                pa.array(list(map(len, words)), pa.int64()),
                pa.array([b" ".join(w) for w in words], pa.binary()).cast(pa.string()),
                pa.array([t or None for t in tiles], pa.list_(_ARROW_TILE)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "text", "tiles"])


def _joined(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments (period, from, to) of one tile, with those of one run put together."""
    out: list[tuple[int, int, int]] = []
    for q, lo, hi in sorted(found):
        if out and out[-1][0] == q and lo <= out[-1][2] - q:
            out[-1] = (q, out[-1][1], max(out[-1][2], hi))
        else:
            out.append((q, lo, hi))
    return out


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "period", "lo", "hi"]
    for b in batches:
        found: list[tuple[int, int, int, int]] = []
        for i in range(b.num_rows):
            row, n, octave, start, boundaries, words = (c[i].as_py() for c in b.columns)
            found += [(row, *f) for f in _joined(list(fragments(octave, boundaries, words, start, n)))]
        columns = zip(*found) if found else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        texts = []
        for text, runs in zip(b.column(3).to_pylist(), b.column(2).to_pylist()):
            words = text.split(" ")
            change = np.zeros(len(words) + 1, np.int64)
            for r in runs:
                change[r["start"] + r["period"]] += 1
                change[r["start"] + r["length"]] -= 1
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            texts.append(text if len(kept) == len(words) else " ".join([words[i] for i in kept]))
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(texts, pa.string())], ["id", "n_words", "runs", "collapsed"])


def stitched(found: DataFrame) -> DataFrame:
    """row, start, length, period of the runs whose fragments (row, period, lo, hi) are given.

    Fragments of one run overlap by a period at least; two runs of one
    period overlap by less.
    """
    order = Window.partitionBy("row", "period").orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("lo") > reach - F.col("period")), 1).otherwise(0)
    marked = found.distinct().withColumn("new", new)
    part = marked.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = part.groupBy("row", "period", "part").agg(F.min("lo").alias("start"), F.max("hi").alias("stop"))
    whole = whole.withColumn("length", F.col("stop") - F.col("start"))
    return whole.filter(F.col("length") >= F.greatest(F.lit(LEAST), PERIODS * F.col("period"))).select("row", "start", "length", "period")


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, runs (array of start, length, period, by start, then period) and collapsed, one row per row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a stretch
    with smallest period q of 4q words or more, and of 6 or more, that no
    neighbouring word extends.  ``collapsed`` holds the words that no run
    contains after its first period, joined by one space.  A null, empty or
    blank text has no words and no runs, and collapses to an empty text.
    Rows count one by one, also with null or repeated ids; other columns
    are left out, so their names cannot clash.  Texts of any length are
    taken whole; a task holds about 512 KB of text, or one longer text, at
    a time.  An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = rows.mapInArrow(_tiled, f"id {kind}, n_words long, text string, tiles array<struct<{TILE}>>")
    cut = written(cut.withColumn("row", F.monotonically_increasing_id()), "runs-tiles", "zstd")
    tiles = cut.filter("tiles is not null").select("row", "n_words", F.explode("tiles").alias("t"))
    # each tile goes to a task of its own choice, wherever its document was read
    dealt = tiles.select("row", "n_words", "t.*").repartition(F.xxhash64("row", "octave", "start"))
    found = dealt.mapInArrow(_solve, "row long, period long, lo long, hi long")
    of_row = F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs")  # of one document
    runs = stitched(found).groupBy("row").agg(of_row)
    none = F.array().cast(f"array<struct<{RUN}>>")
    held = cut.filter("tiles is not null").select("row", "id", "n_words", "text").join(runs, "row", "left")
    held = held.select("id", "n_words", F.coalesce("runs", none).alias("runs"), "text")
    out = held.mapInArrow(_collapse, f"id {kind}, n_words long, runs array<struct<{RUN}>>, collapsed string")
    plain = cut.filter("tiles is null").select("id", "n_words", none.alias("runs"), F.col("text").alias("collapsed"))
    return out.unionByName(plain).withColumnRenamed("id", id_col)
