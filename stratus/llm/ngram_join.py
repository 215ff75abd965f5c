"""Exact Jaccard self-join of documents on word shingles, by partitioning the universe.

Two sets with a similarity of at least t differ in at most
H = (1 - t) / t * s elements, s being the smaller size.  Shingles are
hashed into segments, by a layout per size band, so a pair's differences
are spread over the segments (pigeonhole): among segments worth H + 1
units, at least one holds no difference (an exact segment, one unit) or at
most one (a deletable segment, two units: its one-deletion neighbourhood
is indexed as well).

1. ``band_layout`` allocates exact and deletable segments per band by an
   estimate of rows emitted and of weak segments that many sets share.
2. Every document emits its segments' hashes in the layout of its own band
   and, where a smaller partner may lie there, of the band below.
3. Hashes that only one document has prove that no partner shares the
   segment.  A document whose unshared segments are worth its H + 1 units
   has no partner at all and drops out: nearly all unrelated documents do.
   Empty segments are emitted only by documents that are short of units
   without them; those rule out partners that are short as well, and keep
   their other rows for partners that are not.
   Of documents with equal sets only the smallest goes on.
4. The others probe with their cheapest shared segments (by how many
   documents share them) until their units are covered.
5. The members of each hash meet at its smallest document, the center, and
   are compared there, exactly and by whole texts, in task groups of
   bounded size.  First every member is compared with the center: linear,
   and nearly all copies are attached then.  Members that no link connects
   to their center are compared with the others of its meeting where a
   probed hash is common and the two are not yet connected.

No group is collected: a hash that many documents share is counted per
chunk in the map tasks, and its members travel on by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import written
from stratus.llm.components import connected_components
from stratus.llm.hashing import mix64
from stratus.llm.words import folded_words, groups, slices

# Production parameters: shingle width and similarity (percent)
WIDTH, PERCENT = 5, 80
# rows a map task counts together, and the members from which a hash is hot in such a chunk
_CHUNK, _HOT = 2**18, 32
# cost of a segment with at most one element, in rows; spare units beyond the need
_WEAK, _SPARE = 3.5, 0.08
# documents of a meeting's block
_BLOCK = 400
# kinds of rows: of a hash's group, a hot hash's member, and the same for the digests of whole sets
_GROUPED, _MEMBER, _SET, _COPY = range(4)
# units to spare that a row can name; more count as so many, which rules out less
_SLACK = 2**26 - 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hashes and text numbers, in the order of text and hash.

    A text of fewer than ``width`` words has the whole sequence as its only
    shingle; one without words has none.
    """
    words, of, _ = folded_words(texts)
    n = np.bincount(of, minlength=len(texts))
    starts = np.cumsum(n) - n
    h = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        h = h * _STEP + words[k : k + len(h)]
    use = np.flatnonzero(np.arange(len(h)) - starts[of[: len(h)]] + width <= n[of[: len(h)]])
    h, owner = h[use], of[use]
    few = np.flatnonzero((n > 0) & (n < width))
    if len(few):
        whole = np.zeros(len(few), np.uint64)
        for k in range(width - 1):
            there = n[few] > k
            whole[there] = whole[there] * _STEP + words[starts[few][there] + k]
        at = np.searchsorted(owner, few)
        h, owner = np.insert(h, at, whole), np.insert(owner, at, few)
    h = mix64(h + np.minimum(n[owner], width).astype(np.uint64))
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    begin = 0
    for end in ends.tolist():
        h[begin:end].sort()
        begin = end
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[fresh], owner[fresh]


def differences(size: np.ndarray | int, percent: int = PERCENT) -> np.ndarray | int:
    """H: how much two similar sets differ at most when the smaller has ``size`` elements."""
    return size * (100 - percent) // percent


@lru_cache(maxsize=64)
def band_starts(most: int, percent: int = PERCENT) -> np.ndarray:
    """Smallest size of each band, until one lies above ``most``; bands grow by half, and by 1 / t at least."""
    starts = [1]
    while starts[-1] <= most:
        wide = max(1.5, 100 / percent)
        first = -(-percent // (100 - percent)) if percent < 100 else 2
        starts.append(first if len(starts) == 1 and first > 1 else max(starts[-1] + 1, int(np.ceil(starts[-1] * wide))))
    return np.array(starts)


@lru_cache(maxsize=4096)
def band_layout(band: int, percent: int = PERCENT) -> tuple[int, int, int]:
    """Segments, deletable segments (the first ones) and largest size of a band.

    A deletable segment is worth two units but is indexed with all its
    one-deletion variants; fewer, larger segments are in turn seldom weak.
    The cheapest split of the units is taken.
    """
    most = 1
    while len(band_starts(most, percent)) < band + 2:
        most *= 2
    starts = band_starts(most, percent)
    largest = int(starts[band + 1]) - 1
    mean = (int(starts[band]) + largest) / 2
    need = int(differences(largest, percent)) + 1
    if need == 1:
        return 1, 0, largest
    units = need + 1 + int(_SPARE * need)
    x = np.arange(0, units // 2 + 1)
    m = units - x
    held = mean / m
    rows = (units - 2 * x) + x * (held + 1)
    cost = rows + _WEAK * m * np.exp(-held) * (1 + held)
    deletable = int(x[np.argmin(cost)])
    return units - deletable, deletable, largest


def _segments(h: np.ndarray, of: np.ndarray, sizes: np.ndarray, bands: np.ndarray, percent: int):
    """Rows (hash, document number, meta) of sets ``h`` (with numbers ``of``) in the layout of the band of each."""
    layout = np.array([band_layout(int(b), percent) for b in np.unique(bands)]).reshape(-1, 3)
    m, deletable, largest = layout[np.searchsorted(np.unique(bands), bands)].T
    base = np.cumsum(m) - m
    cells = int(m.sum())
    seg = (mix64(h + bands[of].astype(np.uint64) * _STEP) % m[of].astype(np.uint64)).astype(np.int64)
    cell = base[of] + seg
    # sums modulo 2^64 from two halves, each exact in a double
    low = np.bincount(cell, (h & np.uint64(0xFFFFFFFF)).astype(float), cells).astype(np.uint64)
    high = np.bincount(cell, (h >> np.uint64(32)).astype(float), cells).astype(np.uint64)
    total = low + (high << np.uint64(32))
    held = np.bincount(cell, minlength=cells)
    doc = np.repeat(np.arange(len(m)), m)
    number = np.arange(cells) - base[doc]
    weight = 1 + (number < deletable[doc])
    # one element's removal leaves the empty segment, which a partner need not emit: worth one unit only
    sure = np.where(held > 1, weight, held)
    need = differences(np.minimum(sizes, largest), percent) + 1
    slack = np.bincount(doc, sure, len(m)).astype(np.int64) - need
    # a document short of units emits its empty segments too: among short ones every segment has its full worth
    short = slack < 0
    slack = np.where(short, m + deletable - need, slack)
    weight = np.where(short[doc], weight, np.maximum(sure, 1))
    out = (held > 0) | short[doc]
    salt = mix64((bands[doc].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64))
    meta = (bands[doc] << 57) | (number << 29) | (weight - 1) << 28 | short[doc].astype(np.int64) << 27 | (held == 0).astype(np.int64) << 26
    meta |= np.minimum(slack, _SLACK)[doc]
    variant = np.flatnonzero(number[cell] < deletable[of])
    c = cell[variant]
    return (
        np.concatenate([mix64(total[out] + salt[out]), mix64(total[c] - h[variant] + salt[c])]),
        np.concatenate([doc[out], of[variant]]),
        np.concatenate([meta[out], meta[c]]),
    )


def _chunk(sig: np.ndarray, doc: np.ndarray, meta: np.ndarray, sets: tuple[np.ndarray, ...], most: int) -> pa.RecordBatch:
    """A chunk's rows: sig, doc, meta, n and kind.

    Of a hot hash one row goes on to its group, for all members (n: how
    many); the members' rows carry n as well and stay out of the group.
    Whole sets come as (first digest, document, second digest, size); of a
    set that is hot in the chunk the smallest document goes on, and the
    others name it in place of the digest.
    """
    order = np.argsort(sig)
    sig, doc, meta = sig[order], doc[order], meta[order]
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(sig)))
    hot = count > most
    member = np.repeat(hot, count)
    n = np.where(member, np.repeat(count, count), 1)
    digest, owner, second, size = sets
    order = np.lexsort((owner, second, digest))
    digest, owner, second, size = (x[order] for x in (digest, owner, second, size))
    new = np.ones(len(digest), bool)
    new[1:] = (digest[1:] != digest[:-1]) | (second[1:] != second[:-1])
    begin = np.flatnonzero(new)
    held = np.diff(np.append(begin, len(digest)))
    copy = np.repeat(held > most, held) & ~new
    named = np.where(copy, np.repeat(owner[begin], held).view(np.uint64), digest)
    columns = (
        [sig, sig[first[hot]], named],
        [doc, doc[first[hot]], owner],
        [meta, np.full(hot.sum(), -1), second.view(np.int64)],
        [n, count[hot], size],
        [np.where(member, _MEMBER, _GROUPED), np.full(hot.sum(), _GROUPED), np.where(copy, _COPY, _SET)],
    )
    sig, doc, meta, n, kind = map(np.concatenate, columns)
    arrays = [pa.array(sig.view(np.int64)), pa.array(doc), pa.array(meta), pa.array(n.astype(np.int32)), pa.array(kind.astype(np.int8))]
    return pa.RecordBatch.from_arrays(arrays, ["sig", "doc", "meta", "n", "kind"])


def _emit(width: int, percent: int, hot: int):
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        sets: list[tuple] = []
        rows = 0
        for b in slices(batches):
            ids = b.column(0).to_numpy()
            for first, some in groups([t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]):
                h, of = shingles(some, width)
                sizes = np.bincount(of, minlength=len(some))
                here = ids[first : first + len(some)]
                there = np.flatnonzero(sizes)
                begin = (np.cumsum(sizes) - sizes)[there]
                digests = [np.add.reduceat(x, begin) if len(begin) else none[0] for x in (mix64(h), mix64(h ^ _STEP))]
                sets.append((digests[0], here[there], digests[1], sizes[there]))
                if not len(h):
                    continue
                starts = band_starts(int(sizes.max()), percent)
                own = np.searchsorted(starts, sizes, side="right") - 1
                least = -(-sizes * percent // 100)
                below = np.searchsorted(starts, least, side="right") - 1
                for bands, on in ((own, sizes > 0), (below, (sizes > 0) & (below < own))):
                    if not on.any():
                        continue
                    new = np.cumsum(on) - 1
                    use = on[of]
                    sig, doc, meta = _segments(h[use], new[of[use]], sizes[on], bands[on], percent)
                    held.append((sig, here[on][doc], meta))
                    rows += len(sig)
                if rows >= _CHUNK:
                    yield _chunk(*map(np.concatenate, zip(*held)), tuple(map(np.concatenate, zip(*sets))), hot)
                    held, sets, rows = [], [], 0
        if sets:
            yield _chunk(*(map(np.concatenate, zip(*held)) if held else none), tuple(map(np.concatenate, zip(*sets))), hot)

    return run


def _runs(batches: Iterator[pa.RecordBatch], column: int, rows: int = 2**17, split: bool = False) -> Iterator[list[np.ndarray]]:
    """The columns of a sorted partition in parts that end where the value of ``column`` does.

    A task holds one part at a time, however large its partition is; with
    ``split``, however often a value comes: one that fills a part goes on in
    the next.
    """
    held: list[pa.RecordBatch] = []
    n = 0

    def part(upto: int | None) -> list[np.ndarray]:
        nonlocal held, n
        whole = pa.Table.from_batches(held)
        out = [c.to_numpy() for c in whole.columns]
        upto = len(whole) if upto is None else int(np.searchsorted(out[column], out[column][-1]))
        held, n = whole.slice(upto).to_batches(), len(whole) - upto
        return [c[:upto] for c in out]

    most = rows
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= most:
            columns = part(0)
            if len(columns[0]):
                yield columns
            elif split:
                yield part(None)
            most = max(rows, 2 * n)
    if n:
        yield part(None)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition sorted by hash -> sig, doc, meta, cost, kind.

    Grouped rows: those of hashes that two documents share, and how many
    share them.  Sets: the smallest document of equal sets in place of sig,
    the size in place of meta.  Of a hash that fills more than a part, each
    row's number is what was counted up to the end of its part: enough to
    be dear, which is all that the number decides beyond 1.  Equal sets that
    fill more than a part keep one document per part; these meet later.
    """
    last, before = 0, 0
    for columns in _runs(batches, 0, split=True):
        sig, n, kind = columns[0], columns[3], columns[4]
        before = before if sig[0] == last else 0
        yield _shared_part(*columns, before)
        before = (before if sig[0] == sig[-1] else 0) + int(n[(sig == sig[-1]) & (kind == _GROUPED)].sum(dtype=np.int64))
        last = sig[-1]


def _shared_part(sig: np.ndarray, doc: np.ndarray, meta: np.ndarray, n: np.ndarray, kind: np.ndarray, before: int) -> pa.RecordBatch:
    """``before``: rows of the first hash in earlier parts."""
    n = n.astype(np.int64)
    at = np.flatnonzero(kind == _GROUPED)
    first = np.flatnonzero(np.concatenate([[True], sig[at][1:] != sig[at][:-1]])) if len(at) else at
    total = np.add.reduceat(n[at], first) if len(at) else at
    if len(at) and sig[at[0]] == sig[0]:
        total[0] += before
    cost = np.repeat(total, np.diff(np.append(first, len(at))))
    keep = (cost > 1) & (meta[at] >= 0)
    at, cost = at[keep], cost[keep]
    member = np.flatnonzero(kind == _MEMBER)
    whole = np.flatnonzero(kind == _SET)
    whole = whole[np.lexsort((doc[whole], meta[whole], sig[whole]))]
    new = np.ones(len(whole), bool)
    new[1:] = (sig[whole][1:] != sig[whole][:-1]) | (meta[whole][1:] != meta[whole][:-1])
    smallest = doc[whole][new][np.cumsum(new) - 1] if len(whole) else whole
    copy = np.flatnonzero(kind == _COPY)
    zero = np.zeros(len(whole) + len(copy), np.int64)
    out = (
        [sig[at], sig[member], smallest, sig[copy]],
        [doc[at], doc[member], doc[whole], doc[copy]],
        [meta[at], meta[member], n[whole], n[copy]],
        [cost, n[member], zero],
        [np.full(len(at) + len(member), _GROUPED), zero + _SET],
    )
    arrays = [pa.array(np.concatenate(x)) for x in out]
    return pa.RecordBatch.from_arrays([*arrays[:4], arrays[4].cast(pa.int8())], ["sig", "doc", "meta", "cost", "kind"])


def _allocate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition sorted by document -> sig, doc, meta, kind, probe.

    Rows of sets pass.  Grouped rows stay if their document is the smallest
    of its set and can have a partner; ``probe`` marks the allocated ones.
    """
    for columns in _runs(batches, 1):
        yield from _allocate_part(*columns)


def _allocate_part(sig: np.ndarray, doc: np.ndarray, meta: np.ndarray, cost: np.ndarray, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = ["sig", "doc", "meta", "kind", "probe"]
    whole = np.flatnonzero(kind == _SET)
    if len(whole):
        yield pa.RecordBatch.from_arrays([*(pa.array(x[whole]) for x in (sig, doc, meta, kind)), pa.array(np.zeros(len(whole), bool))], names)
    copies = doc[whole][sig[whole] != doc[whole]]
    use = np.flatnonzero((kind == _GROUPED) & ~np.isin(doc, copies))
    if not len(use):
        return
    sig, doc, meta, cost = sig[use], doc[use], meta[use], cost[use]
    segment = meta >> 29
    # a segment (of a document and band) costs what its shared hashes cost together
    order = np.lexsort((segment, doc))
    sig, doc, meta, segment, cost = (x[order] for x in (sig, doc, meta, segment, cost))
    first = np.flatnonzero(np.concatenate([[True], (segment[1:] != segment[:-1]) | (doc[1:] != doc[:-1])]))
    rows = np.diff(np.append(first, len(sig)))
    price = np.add.reduceat(cost, first)
    # texts that repeat an id may differ in worth and slack: what rules out least holds
    d, b, w = doc[first], segment[first] >> 28, np.maximum.reduceat((meta >> 28) & 1, first) + 1
    spare, short = np.minimum.reduceat(meta & _SLACK, first), np.maximum.reduceat((meta >> 27) & 1, first)
    empty = np.minimum.reduceat((meta >> 26) & 1, first)
    order = np.lexsort((segment[first], price, b, d))  # cheapest first within a document and band
    d, b, w, spare, short, empty = (x[order] for x in (d, b, w, spare, short, empty))
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (b[1:] != b[:-1])])
    group = np.cumsum(new) - 1
    spare, short = np.minimum.reduceat(spare, np.flatnonzero(new))[group], np.maximum.reduceat(short, np.flatnonzero(new))[group]
    run = np.cumsum(w)
    before = run - w - (run - w)[np.flatnonzero(new)][group]
    matched = np.bincount(group, w).astype(np.int64)[group]
    # units that shared segments must bring in; none: unshared segments alone rule every partner out
    owed = matched - spare
    keep, probe = np.empty(len(order), bool), np.empty(len(order), bool)
    # a partner that is not short does not emit empty segments, so these rule out short ones only: it probes, the rest stays
    keep[order], probe[order] = (owed > 0) | ((short > 0) & (empty == 0)), before < owed
    keep, probe = np.repeat(keep, rows), np.repeat(probe, rows)
    kinds = pa.array(np.full(int(keep.sum()), _GROUPED, np.int8))
    yield pa.RecordBatch.from_arrays([*(pa.array(x[keep]) for x in (sig, doc, meta)), kinds, pa.array(probe[keep])], names)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=1)
    for b in slices(batches):
        packed = [z.compress(t or b"") for t in b.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], ["doc", "packed"])


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) or not len(x) or not len(y):
        return False
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _sets(packed: pa.ChunkedArray, width: int) -> list[np.ndarray]:
    z = zstandard.ZstdDecompressor()
    h, of = shingles([z.decompress(p) for p in packed.to_pylist()], width)
    return np.split(h, np.cumsum(np.bincount(of, minlength=len(packed)))[:-1])


def _links(pairs: list[tuple[int, int]]) -> pa.Table:
    a, b = np.array(pairs, np.int64).reshape(-1, 2).T
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def _attach(width: int, percent: int):
    """A block of a meeting and its center -> links of the center."""

    def run(meeting: pa.Table) -> pa.Table:
        doc, center = meeting.column("doc").to_numpy(), meeting.column("center")[0].as_py()
        sets = _sets(meeting.column("packed"), width)
        at = int(np.flatnonzero(doc == center)[0])
        return _links([(center, d) for d, x in zip(doc, sets) if d != center and similar(sets[at], x, percent)])

    return run


def _compare(width: int, percent: int):
    """Two blocks of a meeting -> links a, b that connect what the whole texts connect."""

    def run(meeting: pa.Table) -> pa.Table:
        doc, side = meeting.column("doc").to_numpy(), meeting.column("side").to_numpy()
        root = np.unique(meeting.column("component").to_numpy(), return_inverse=True)[1]
        lists = meeting.column("sigs").combine_chunks()
        row = np.repeat(np.arange(len(doc)), np.asarray(lists.value_lengths()))
        sig, probe = (lists.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        order = np.argsort(sig, kind="stable")
        sig, row, probe = sig[order], row[order], probe[order]
        edges = np.append(np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])), len(sig))
        apart = np.minimum.reduceat(root[row], edges[:-1]) != np.maximum.reduceat(root[row], edges[:-1])
        common = np.zeros((len(doc), len(doc)), bool)
        for i, j in zip(edges[:-1][apart], edges[1:][apart]):
            common[np.ix_(row[i:j][probe[i:j]], row[i:j])] = True
        common |= common.T
        if side.min() != side.max():  # pairs inside a block are compared where it meets itself
            common &= side[:, None] != side[None, :]
        common &= root[:, None] != root[None, :]
        used = np.flatnonzero(common.any(axis=1))
        sets = dict(zip(used.tolist(), _sets(meeting.column("packed").take(pa.array(used)), width)))
        found = []
        for i, j in np.argwhere(np.triu(common, 1)).tolist():
            if root[i] != root[j] and similar(sets[i], sets[j], percent):
                found.append((doc[i], doc[j]))
                root[root == root[j]] = root[i]
        return _links(found)

    return run


def _members(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Written table of center, doc, sigs (hash and probe), packed: who meets where, with its whole text."""
    centers = rows.groupBy("sig").agg(F.min("doc").alias("center"), F.count(F.lit(1)).alias("n"), F.max("probe").alias("any"))
    # joins of written tables, here and below: Spark can split a hash or a meeting with very many members
    centers = written(centers.filter("n > 1 and any").select("sig", "center"), "ngram-centers")
    met = rows.join(centers, "sig").groupBy("center", "doc").agg(F.collect_list(F.struct("sig", "probe")).alias("sigs"))
    met = written(met, "ngram-meetings")
    packed = texts.mapInArrow(_pack, "doc long, packed binary").join(met.select("doc").distinct(), "doc", "left_semi")
    packed = written(packed.dropDuplicates(["doc"]), "ngram-texts")
    return written(met.join(packed, "doc"), "ngram-members")


def _blocks(rows: DataFrame, most: int, *counts: tuple[str, F.Column]) -> DataFrame:
    """``rows`` with the number of blocks of each of the ``counts`` (name, which rows) per center."""
    sizes = rows.groupBy("center").agg(*[F.ceil(F.count_if(on) / most).cast("int").alias(name) for name, on in counts])
    return rows.join(written(sizes, "ngram-blocks"), "center")


def _upto(n: F.Column) -> F.Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _star_links(members: DataFrame, width: int, percent: int, most: int) -> DataFrame:
    """Links between centers and members: blocks of members, the center in each."""
    m = _blocks(members.drop("sigs"), most, ("blocks", F.lit(True)))
    own = F.array(F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    at = F.when(F.col("doc") == F.col("center"), _upto(F.col("blocks"))).otherwise(own)
    m = m.select("center", F.explode(at).alias("block"), "doc", "packed")
    return m.groupBy("center", "block").applyInArrow(_attach(width, percent), "a long, b long")


def _rest_links(members: DataFrame, components: DataFrame, width: int, percent: int, most: int) -> DataFrame:
    """Links between members that are not connected to their center, and the other members of the meeting.

    Blocks of such members meet each other and the blocks of connected
    ones; the latter never meet each other.
    """
    c = components.select(F.col("node").alias("doc"), "component")
    m = members.join(c, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    m = m.join(c.select(F.col("doc").alias("center"), F.col("component").alias("of")), "center", "left")
    m = written(m.withColumn("loose", F.col("component") != F.coalesce("of", "center")).drop("of"), "ngram-loose")
    m = _blocks(m, most, ("loose_blocks", F.col("loose")), ("tied_blocks", ~F.col("loose"))).filter("loose_blocks > 0")
    n = F.when(F.col("loose"), F.col("loose_blocks")).otherwise(F.col("tied_blocks"))
    own = F.pmod(F.xxhash64("doc"), n).cast("int")
    key = lambda tied, lo, hi, side: F.struct(F.lit(tied).alias("tied"), lo.alias("lo"), hi.alias("hi"), side.alias("side"))
    loose = F.concat(
        F.transform(_upto(F.col("loose_blocks")), lambda i: key(False, F.least(i, own), F.greatest(i, own), own)),
        F.transform(_upto(F.col("tied_blocks")), lambda i: key(True, own, i, F.lit(-1))),
    )
    tied = F.transform(_upto(F.col("loose_blocks")), lambda i: key(True, i, own, F.lit(-2)))
    m = m.select("center", "doc", "component", "sigs", "packed", F.explode(F.when(F.col("loose"), loose).otherwise(tied)).alias("at"))
    m = m.select("center", "at.*", "doc", "component", "sigs", "packed")
    return m.groupBy("center", "tied", "lo", "hi").applyInArrow(_compare(width, percent), "a long, b long")


def _candidates(texts: DataFrame, width: int, percent: int, hot: int) -> DataFrame:
    """Written table of sig, doc, meta, kind, probe: sets of all documents, and the rows of those that may have partners."""
    emitted = texts.mapInArrow(_emit(width, percent, hot), "sig long, doc long, meta long, n int, kind byte")
    by_group = F.when(F.col("kind").isin(_GROUPED, _SET), F.col("sig")).otherwise(F.xxhash64("doc"))
    shared = emitted.repartition(by_group).sortWithinPartitions("sig").mapInArrow(_shared, "sig long, doc long, meta long, cost long, kind byte")
    kind = "sig long, doc long, meta long, kind byte, probe boolean"
    return written(shared.repartition("doc").sortWithinPartitions("doc").mapInArrow(_allocate, kind), "ngram-rows")


def _peeled(rows: DataFrame) -> DataFrame:
    """Allocates again among the documents that are left: without the others, fewer hashes are shared."""
    cost = written(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("cost")).filter("cost > 1"), "ngram-costs")
    again = rows.join(cost, "sig").select("sig", "doc", "meta", "cost", "kind").repartition("doc").sortWithinPartitions("doc")
    kind = "sig long, doc long, meta long, kind byte, probe boolean"
    return written(again.mapInArrow(_allocate, kind), "ngram-peeled")


def similar_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    hot: int = _HOT,
    block: int = _BLOCK,
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Rows link when 100 * intersection >= percent * union of their sets of
    ``width``-word shingles; component_id is the smallest id reachable by
    links, the row's own id without links.  Null and blank texts have no
    shingles and no links.  Ids are integers.  Rows that repeat an id are
    one document: the same n_shingles (the largest), linked by one of their
    texts.  Rows with a null id have null in the other two columns.  Other
    columns are left out; an empty table gives an empty result.  ``hot`` and
    ``block`` say from how many members a chunk's hash, and a meeting, is
    split; they do not change the result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = source.filter("doc_id is not null and text is not null")
    rows = _candidates(texts, width, percent, hot)
    sets = rows.filter(F.col("kind") == _SET).select("doc", F.col("sig").alias("same"), F.col("meta").alias("size"))
    left = _peeled(rows.filter(F.col("kind") == _GROUPED))
    members = _members(left, texts)
    links = written(
        _star_links(members, width, percent, block).union(sets.filter("doc <> same").select("doc", "same")), "ngram-links"
    )
    components = connected_components(links)
    rest = written(_rest_links(members, components, width, percent, block), "ngram-rest")
    components = connected_components(components.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest))
    sizes = sets.groupBy("doc").agg(F.max("size").alias("size"))
    out = source.select("doc_id").join(sizes.withColumnRenamed("doc", "doc_id"), "doc_id", "left")
    out = out.join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    known = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id",
        F.when(known, F.coalesce("size", F.lit(0))).cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
