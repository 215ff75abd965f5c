"""Near-duplicate lines across all documents, by a deletion-neighbourhood join.

A line is its sequence of words (A-Z lower-cased).  Two lines are alike
when their words are equal, or, from ``MIN_NEAR`` words on, when one word
is inserted, deleted or replaced between them.  A line goes if an alike
line stands earlier, in the order (document id, line number); the earliest
stays, and lines without words stay.

1. Every line gets a 128-bit key of its words; one aggregate finds the
   first place of the lines that occur more than once.
2. One edit leaves one half of a line whole, so only lines that share a
   half with another line can have a neighbour.  These few lines are
   fetched, and each emits its deletion neighbourhood: the hash of its
   words, and of its words without word i, for every i.
3. Equal variants are joined.  Lines that lack the same place's word are
   all within one edit of each other, and a line is within one edit of all
   that give it by a deletion; so the smallest place per variant names an
   earlier neighbour, and no pairs within a group are formed.  The pair's
   edit distance is then verified on its words.
4. Dropped places are gathered per document and cut out of its text.

Every step is an aggregate with partial sums or a join that Spark can
split, so a line that a third of all documents share stays spread out.
Texts cross the shuffle packed (zstd) together with a hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import free_name, written
from stratus.llm.hashing import mix64, powers
from stratus.llm.words import folded_words, groups, slices

# Production parameter: lines of fewer words must be equal to be alike
MIN_NEAR = 8
_SECOND = np.uint64(0xA24BAED4963EE407)


def _sequence_sums(words: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cumulated words * base^place (place within the line), one longer than ``words``, and each word's place."""
    place = np.arange(len(words)) - np.repeat(starts, counts)
    terms = words * powers(int(counts.max()) + 1)[place]
    return np.concatenate([[np.uint64(0)], np.cumsum(terms)]), place


def _finish(sums: np.ndarray, n: np.ndarray) -> np.ndarray:
    return mix64(sums + n.astype(np.uint64) * _SECOND)


def _inverse_powers(n: int) -> np.ndarray:
    base = int(powers(2)[1])
    inverse = np.full(n, pow(base, -1, 2**64), np.uint64)
    inverse[0] = 1
    return np.multiply.accumulate(inverse)


def _lines(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per group of texts: text number, line number, first word, words per line; and all words."""
    for first, some in groups(texts):
        words, of, at = folded_words(some)
        if not len(words):
            continue
        data = np.frombuffer(b"".join(some), np.uint8)
        begins = np.cumsum([0] + [len(t) for t in some])
        breaks = np.flatnonzero(data == 10)
        line = np.searchsorted(breaks, at) - np.searchsorted(breaks, begins)[of]
        new = np.concatenate([[True], (line[1:] != line[:-1]) | (of[1:] != of[:-1])])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(words)))
        yield of[starts] + first, line[starts], starts, counts, words


def _half_keys(sums: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first and the last words that one edit may leave whole, four per line.

    The shorter line of a pair within one edit has n or n - 1 of the words;
    of its first half and its last half one is whole in both lines.
    """
    back = _inverse_powers(int(counts.max()) + 1)
    out = []
    for shorter in (counts, counts - 1):
        head = shorter // 2
        tail = shorter - head
        out.append(_finish(sums[starts + head] - sums[starts], head))
        out.append(_finish((sums[starts + counts] - sums[starts + counts - tail]) * back[counts - tail], -tail))
    return out


def _line_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, text -> doc_id, text_hash, line_no, k1, k2, halves for every line with words.

    ``halves`` is null for lines too short to have a neighbour.
    """
    names = ["doc_id", "text_hash", "line_no", "k1", "k2", "halves"]
    for b in slices(batches):
        for of, line, starts, counts, words in _lines([t or b"" for t in b.column(2).cast(pa.binary()).to_pylist()]):
            ends = starts + counts
            sums, _ = _sequence_sums(words, starts, counts)
            second, _ = _sequence_sums(mix64(words ^ _SECOND), starts, counts)
            keys = [pa.array(_finish(x[ends] - x[starts], counts).view(np.int64)) for x in (sums, second)]
            four = np.column_stack(_half_keys(sums, starts, counts)).ravel().view(np.int64)
            halves = pa.FixedSizeListArray.from_arrays(pa.array(four), 4).cast(pa.list_(pa.int64()))
            halves = pc.if_else(pa.array(counts >= MIN_NEAR), halves, pa.scalar(None, halves.type))
            rows = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), b.column(1).take(rows), pa.array(line.astype(np.int32)), *keys, halves], names
            )


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k1, line -> k1, variant, gap: the line's hash (gap -1) and those without word ``gap``."""
    for b in slices(batches):
        for of, _, starts, counts, words in _lines([t.replace(b"\n", b" ") for t in b.column(1).to_pylist()]):
            sums, place = _sequence_sums(words, starts, counts)
            ends = starts + counts
            head = sums[:-1] - np.repeat(sums[starts], counts)
            tail = np.repeat(sums[ends], counts) - sums[1:]
            gone = _finish(head + tail * _inverse_powers(2)[1], np.repeat(counts - 1, counts))
            whole = _finish(sums[ends] - sums[starts], counts)
            rows = np.concatenate([np.repeat(of, counts), of])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(np.concatenate([gone, whole]).view(np.int64)),
                 pa.array(np.concatenate([place, np.full(len(of), -1)]).astype(np.int32))],
                ["k1", "variant", "gap"],
            )


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one insertion, deletion or replacement (or none) turns one sequence into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if head == len(a):
        return True
    rest = len(a) - head - (len(a) == len(b))
    return a[len(a) - rest :] == b[len(b) - rest :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fold = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    for b in batches:
        pairs = zip(b.column(2).to_pylist(), b.column(3).to_pylist())
        yield b.filter(pa.array([within_one_edit(*(t.translate(fold).split() for t in p)) for p in pairs], pa.bool_())).select([0, 1])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=1)
    for b in slices(batches):
        packed = [None if t is None else z.compress(t) for t in b.column(2).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], ["doc_id", "text_hash", "packed"])


def _unpacked(column: pa.Array) -> list[bytes | None]:
    z = zstandard.ZstdDecompressor()
    return [None if t is None else z.decompress(t) for t in column.to_pylist()]


def _pick_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """packed, wanted (line_no, k1 ...) -> k1, line for each wanted line."""
    for b in slices(batches):
        k1, line = [], []
        for text, wanted in zip(_unpacked(b.column(0)), b.column(1).to_pylist()):
            all_lines = text.split(b"\n")
            for w in wanted:
                k1.append(w["k1"])
                line.append(all_lines[w["line_no"]])
        yield pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(line, pa.binary())], ["k1", "line"])


def _by_row(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on (doc_id, text_hash), where null ids equal each other."""
    r = right.withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"})
    return left.join(r, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), how).drop("_d", "_h")


def near_lines(keyed: DataFrame, lines: DataFrame, places: DataFrame) -> DataFrame:
    """k1 of the lines that have an earlier line within one edit, and that line's k1 (``earlier``).

    ``lines`` holds text lines (k1, line) and ``places`` their first place.
    """
    emitted = written(lines.mapInArrow(_variants, "k1 long, variant long, gap int"), "line-variants")
    shared = emitted.groupBy("variant").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).filter("a <> b").select("variant")
    shared = written(shared, "line-shared")
    v = written(emitted.join(shared, "variant").join(places.select("k1", "place"), "k1"), "line-shared-variants")
    first = F.min(F.struct("place", "k1"))
    by_gap = written(v.filter("gap >= 0").groupBy("variant", "gap").agg(first.alias("first")), "line-by-gap")
    # written, so that Spark can split a variant that very many lines share
    whole = written(v.filter("gap < 0").groupBy("variant").agg(first.alias("first")), "line-whole")
    any_gap = written(by_gap.groupBy("variant").agg(F.min("first").alias("first")), "line-any-gap")
    found = (
        v.join(by_gap, ["variant", "gap"])
        .unionByName(v.filter("gap >= 0").join(whole, "variant"))
        .unionByName(v.filter("gap < 0").join(any_gap, "variant"))
    )
    found = found.filter(F.col("first.place") < F.col("place"))
    pairs = found.groupBy("k1").agg(F.min("first").alias("first")).select("k1", F.col("first.k1").alias("earlier"))
    other = lines.select(F.col("k1").alias("earlier"), F.col("line").alias("other"))
    pairs = pairs.join(lines, "k1").join(other, "earlier").select("k1", "earlier", "line", "other")
    return pairs.mapInArrow(_verified, "k1 long, earlier long")


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that have an earlier alike line cut out of the text.

    Adds n_lines (lines with words), n_dropped and n_near (dropped for a
    line that differs in a word); an input column of such a name makes the
    added one end in an underscore.  Other columns and untouched texts stay
    as they are, null texts included; a text that loses all its lines
    becomes empty.  Repeated rows of the same id and text count as one
    place, so they are cut alike; null ids come first.
    """
    names = [free_name(docs.columns, c) for c in ("n_lines", "n_dropped", "n_near")]
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    keyed = written(
        source.mapInArrow(_line_keys, f"doc_id {kind}, text_hash long, line_no int, k1 long, k2 long, halves array<long>"), "line-keys"
    )
    place = F.struct("doc_id", "line_no", "text_hash")
    repeated = written(
        keyed.groupBy("k1", "k2").agg(F.min(place).alias("place"), F.max(place).alias("last")).filter("place <> last").drop("last"),
        "line-repeats",
    )

    halves = keyed.select(F.explode("halves").alias("half"), "k1")
    both = halves.groupBy("half").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).filter("a <> b").select("half")
    both = written(both, "line-shared-halves")  # a join of two scans: Spark can split a half that very many lines share
    candidates = written(halves.join(both, "half").select("k1").distinct(), "line-candidate-keys")
    places = written(
        keyed.join(candidates, "k1").groupBy("k1", "k2").agg(F.min(place).alias("place")), "line-candidates"
    )
    wanted = places.groupBy("place.doc_id", "place.text_hash").agg(F.collect_list(F.struct("place.line_no", "k1")).alias("wanted"))
    packed = source.mapInArrow(_pack, f"doc_id {kind}, text_hash long, packed binary")
    lines = written(
        _by_row(packed.filter("packed is not null"), wanted).select("packed", "wanted").mapInArrow(_pick_lines, "k1 long, line binary"),
        "line-texts",
    )
    near = written(near_lines(keyed, lines, places), "line-near")

    decided = repeated.select("k1", "k2", "place", F.lit(False).alias("near")).unionByName(
        places.join(near.select("k1").distinct(), "k1").select("k1", "k2", F.lit(None).cast(repeated.schema["place"].dataType).alias("place"), F.lit(True).alias("near"))
    )
    gone = keyed.join(decided, ["k1", "k2"]).filter(F.col("near") | (F.col("place") != place.cast(repeated.schema["place"].dataType)))
    gone = gone.groupBy("doc_id", "text_hash").agg(
        F.collect_set("line_no").alias("gone"), F.collect_set(F.when(F.col("near"), F.col("line_no"))).alias("gone_near")
    )
    return _cut(docs, gone, id_col, text_col, names)


def _cut(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, names: list[str]) -> DataFrame:
    """Cuts the lines ``gone`` (doc_id, text_hash, gone, gone_near) out of the texts."""
    extra = [c for c in docs.columns if c not in (id_col, text_col)]
    packed = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"), *[F.col(c).alias(f"x{i}") for i, c in enumerate(extra)]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            three = next(_pack(iter([b.select([0, 1, 2])])))
            yield pa.RecordBatch.from_arrays([*three.columns, *b.columns[3:]], [*three.schema.names, *b.schema.names[3:]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, n, dropped, near = [], [], [], []
            lists = zip(_unpacked(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist())
            for text, out, out_near in lists:
                lines = (text or b"").split(b"\n")
                # words are cut at ASCII white space; bytes.split() also cuts at nothing else
                n.append(sum(1 for x in lines if x.split()))
                dropped.append(len(out or ()))
                near.append(len(out_near or ()))
                if out:
                    without = set(out)
                    text = b"\n".join(x for i, x in enumerate(lines) if i not in without)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.binary()).cast(pa.string()), *b.columns[4:], *(pa.array(x, pa.int64()) for x in (n, dropped, near))],
                out_names,
            )

    id_kind = docs.schema[id_col].dataType.simpleString()
    fields = "".join(f", x{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(extra))
    rows = packed.mapInArrow(pack, f"doc_id {id_kind}, text_hash long, packed binary{fields}")
    rows = _by_row(rows, gone, "left").select("doc_id", "packed", "gone", "gone_near", *[f"x{i}" for i in range(len(extra))])
    out_names = ["doc_id", "text", *[f"x{i}" for i in range(len(extra))], "n0", "n1", "n2"]
    done = rows.mapInArrow(cut, f"doc_id {id_kind}, text string{fields}, n0 long, n1 long, n2 long")
    back = {id_col: F.col("doc_id"), text_col: F.col("text"), **{c: F.col(f"x{i}") for i, c in enumerate(extra)}}
    return done.select(*[back[c].alias(c) for c in docs.columns], *[F.col(f"n{i}").alias(name) for i, name in enumerate(names)])
