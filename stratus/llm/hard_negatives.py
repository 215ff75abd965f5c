"""Hard-negative mining with STR-packed R-trees.

The rows are packed as sort-tile-recursive does it, on two levels.  A
bounded sample is cut into slabs of equally many rows along one coordinate
after the other; the cuts deal all rows into tiles, and a tile is spread by
hash over blocks of bounded size, so equal vectors do not pile up.  Inside
its block a task packs the rows the same way, exactly this time, into
leaves, and packs leaves into nodes.

A node knows its minimum bounding box, the labels below it and its
smallest id.  For an anchor a the box gives each coordinate an interval of
products, and their sums the interval of inner products [low, high].  A
best-first queue takes the node with the largest ``high`` next and prunes
nodes whose interval lies outside the score window, whose rows all have
labels that do not count, or that lie strictly below the k-th score (at the
k-th score itself, if their smallest id comes after the k-th row's).

The anchors are the stated query set; they meet all rows in blocks, first
for the positives (same label, any score), then, with the best of all
blocks known, for the negatives of every positive's window.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import written
from stratus.llm.topk_search import fits_double, integer_vectors, matrix, products

# Production parameters: rows that the top level's cuts come from, tiles at most, rows of a block, anchors of a group,
# rows of a leaf, children of a node
SAMPLE, TILES, BLOCK, GROUP, LEAF, FANOUT = 4096, 64, 8192, 4096, 64, 8

_PACKED = "vec_id long, label long, v binary"
_EVERY, _LAST = (-(2**63), 2**63 - 1), 2**63 - 1  # the window of all scores; an id that no id comes behind


def str_order(x: np.ndarray, least: int) -> list[np.ndarray]:
    """Row numbers of ``x`` in tiles of at most ``least`` rows: slabs along the first coordinate, cut along the next one, and so on.

    The number of slabs per coordinate is the root of the number of tiles,
    taken over as many coordinates as give two slabs each.
    """
    tiles = math.ceil(len(x) / least)
    depth = max(1, min(x.shape[1], tiles.bit_length() - 1))
    parts = [np.arange(len(x))]
    for at in range(depth):
        cut = []
        for part in parts:
            n = math.ceil(len(part) / least)
            slabs = n if at == depth - 1 else min(n, math.ceil(n ** (1 / (depth - at))))
            ordered = part[np.argsort(x[part, at % x.shape[1]], kind="stable")]
            # slabs hold whole leaves, but for the last
            size = math.ceil(n / slabs) * least if slabs else 0
            cut += [ordered[i : i + size] for i in range(0, len(ordered), size)] if size else []
        parts = cut
    return parts


def tile_cuts(sample: np.ndarray, tiles: int) -> list:
    """The sample's slabs as nested cuts: (coordinate, cut values, one entry per slab: nested cuts or a tile's number)."""
    numbers = iter(range(10**9))

    def cut(x: np.ndarray, at: int, n: int):
        if n <= 1 or len(x) <= 1:
            return next(numbers)
        slabs = 2 if n < 8 else round(math.sqrt(n))
        order = x[np.argsort(x[:, at], kind="stable")]
        edges = [len(order) * i // slabs for i in range(1, slabs)]
        values = order[edges, at]
        parts = np.split(order, edges)
        return at, values, [cut(p, (at + 1) % x.shape[1], math.ceil(n / slabs)) for p in parts]

    return cut(sample, 0, tiles)


def tiles_of(x: np.ndarray, cuts) -> np.ndarray:
    """The tile of every row."""
    out = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), cuts)]
    while todo:
        rows, node = todo.pop()
        if isinstance(node, int):
            out[rows] = node
            continue
        at, values, below = node
        slab = np.searchsorted(values, x[rows, at], side="right")
        todo += [(rows[slab == i], b) for i, b in enumerate(below) if (slab == i).any()]
    return out


class RTree:
    """Rows (integer vectors, ids, labels) packed into boxes; levels from the leaves to the root."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        leaves = str_order(x, LEAF)
        order = np.concatenate(leaves)
        self.x, self.ids, self.labels = x[order], ids[order], labels[order]
        sizes = np.array([len(p) for p in leaves])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        low = np.minimum.reduceat(self.x, self.starts)
        high = np.maximum.reduceat(self.x, self.starts)
        first = np.minimum.reduceat(self.ids, self.starts)
        # one label of the node's rows, and whether there are others
        label = self.labels[self.starts]
        mixed = np.array([bool((self.labels[a:b] != self.labels[a]).any()) for a, b in zip(self.starts, self.ends)])
        self.levels = [(low, high, first, label, mixed)]
        while len(low) > 1:
            at = np.arange(0, len(low), FANOUT)
            low, high, first = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(first, at)
            other = label != np.repeat(label[at], np.diff(np.append(at, len(label))))
            mixed = np.logical_or.reduceat(mixed | other, at)
            label = label[at]
            self.levels.append((low, high, first, label, mixed))
        self.first = [level[2].tolist() for level in self.levels]
        self.seen = 0  # rows that a search looked at

    def intervals(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level: the least and the largest inner product of every anchor with every box (with room for rounding)."""
        up, down = np.maximum(anchors, 0).astype(np.float64), np.minimum(anchors, 0).astype(np.float64)
        out = []
        for low, high, *_ in self.levels:
            low, high = low.astype(np.float64), high.astype(np.float64)
            least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
            if not fits_double(anchors, self.x):
                room = 1e-9 * (up @ np.abs(high).T - down @ np.abs(low).T + np.abs(most) + np.abs(least)) + 1
                least, most = least - room, most + room
            out.append((least, most))
        return out

    def search(self, i: int, reach, scores, anchor_id: int, label: int, same: bool, k: int, windows: list[tuple[int, int]]):
        """Per window of scores, (score, id) of the ``k`` best rows for anchor ``i``, of its label or of others.

        The windows share one queue, so a leaf is looked at once for all of them.
        """
        highs, wanted = [], []  # per level: each node's largest score, and whether rows below it can count
        for (low, high), (*_, labels, mixed) in zip(reach, self.levels):
            inside = np.zeros(len(labels), bool)
            for least, most in windows:
                inside |= (high[i] >= least) & (low[i] <= most)
            highs.append(high[i].tolist())
            wanted.append((inside & (mixed | ((labels == label) == same))).tolist())
        best: list[list[tuple[int, int]]] = [[] for _ in windows]  # heaps of (score, -id): the k-th row on top
        # what a row must reach to count anywhere: a score, and at this very score an id before
        need, before = min(w[0] for w in windows), _LAST
        queue: list[tuple[float, int, int]] = []

        def push(level: int, nodes: range) -> None:
            high, some, first = highs[level], wanted[level], self.first[level]
            for n in nodes:
                if some[n] and (high[n] > need or (high[n] == need and first[n] < before)):
                    heapq.heappush(queue, (-high[n], level, n))

        top = len(self.levels) - 1
        push(top, range(len(highs[top])))
        while queue:
            high, level, node = heapq.heappop(queue)
            if -high < need:
                break
            if level:
                push(level - 1, range(node * FANOUT, min((node + 1) * FANOUT, len(highs[level - 1]))))
                continue
            a, b = self.starts[node], self.ends[node]
            s = scores(i, a, b)
            self.seen += b - a
            hit = np.flatnonzero((s >= need) & ((self.labels[a:b] == label) == same))
            changed = False
            for score, other in zip(s[hit].tolist(), self.ids[a:b][hit].tolist()):
                if other == anchor_id:
                    continue
                for rows, (least, most) in zip(best, windows):
                    if not least <= score <= most:
                        continue
                    if len(rows) < k:
                        heapq.heappush(rows, (score, -other))
                        changed = True
                    elif (score, -other) > rows[0]:
                        heapq.heapreplace(rows, (score, -other))
                        changed = True
            if changed:
                lacking = [(rows[0][0], -rows[0][1]) if len(rows) == k else (w[0], _LAST) for rows, w in zip(best, windows)]
                need = min(score for score, _ in lacking)
                before = max(other for score, other in lacking if score == need)
        return [sorted(((s, -v) for s, v in rows), key=lambda r: (-r[0], r[1])) for rows in best]


def score_window(score: int, least: int, most: int) -> tuple[int, int]:
    """The whole scores s with least * score <= 100 * s <= most * score."""
    return -(-least * score // 100), most * score // 100


def _scores(anchors: np.ndarray, tree: RTree):
    """Exact inner products of an anchor with the rows of a leaf."""
    if fits_double(anchors, tree.x):
        a, x = anchors.astype(np.float64), tree.x.astype(np.float64)
        return lambda i, lo, hi: (x[lo:hi] @ a[i]).astype(np.int64)
    return lambda i, lo, hi: products(anchors[i : i + 1], tree.x[lo:hi])[0]


def _widths(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1], 1)
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def _mine(k: int, least: int, most: int, same: bool):
    """Searches one block for one group of anchors: the anchor's label without a window, or other labels in a window per positive."""

    def run(anchors: pa.Table, block: pa.Table) -> pa.Table:
        a, x = _widths(matrix(anchors.column("v").to_pylist()), matrix(block.column("w").to_pylist()))
        rows: list[tuple] = []
        if len(a) and len(x):
            tree = RTree(x, block.column("other").to_numpy(), block.column("other_label").to_numpy())
            reach, scores = tree.intervals(a), _scores(a, tree)
            ids, labels = (anchors.column(c).to_pylist() for c in ("vec_id", "label"))
            positives = [[{"of": 0}]] * len(a) if same else anchors.column("positives").to_pylist()
            for i, (one, label, asked) in enumerate(zip(ids, labels, positives)):
                ranges = [(p["of"], _EVERY if same else score_window(p["score"], least, most)) for p in asked]
                ranges = [(of, w) for of, w in ranges if w[0] <= w[1]]
                found = tree.search(i, reach, scores, one, label, same, k, [w for _, w in ranges]) if ranges else []
                rows += [(one, of, other, score) for (of, _), best in zip(ranges, found) for score, other in best]
        columns = zip(*rows) if rows else [[]] * 4
        return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(("anchor_id", "of", "vec_id", "score"), columns)})

    return run


def _pack(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = integer_vectors(b.column(2), scale)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], ["vec_id", "label", "v"])

    return run


def _deal(cuts, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, _ = _widths(matrix(b.column(2).to_pylist()), np.zeros((0, width), np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tiles_of(x, cuts).astype(np.int32))], ["vec_id", "label", "v", "tile"])

    return run


def mine_negatives(
    vectors: DataFrame,
    k: int = 5,
    positives: int = 5,
    every: int = 100,
    window: tuple[int, int] = (80, 100),
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of each anchor's hard negatives.

    Vectors become floor(scale * x); a score is an inner product, higher
    ones come first, then smaller ids.  Anchors are the rows whose id is
    divisible by ``every``; an anchor's positives are its first
    ``positives`` other rows of the same label.  For each positive, the
    first ``k`` rows of other labels are returned whose score is
    ``window`` percent of the positive's (a negative score's window is
    empty, as 80 % of it is more than all of it).  No positive, or no row
    in a window, gives no rows.  A null id, label or vector, or a vector
    with a null or non-finite component takes no part.  Vectors of unequal
    length are filled up with zeros; a component beyond 62 bits or a
    computed score beyond 64 raises.  A repeated id is a candidate as often
    as it occurs, but never for itself; as an anchor, its rows' results are
    ranked together.  Other columns are left out, so their names cannot
    clash.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"))
    rows = rows.filter("vec_id is not null and label is not null")
    packed = written(rows.mapInArrow(_pack(scale), _PACKED).filter("v is not null"), "negatives-vectors")
    total = packed.count()
    if not total:
        return spark.createDataFrame([], out)
    # at most SAMPLE rows
    sample = packed.orderBy(F.md5(F.col("vec_id").cast("string").cast("binary")), "vec_id", "v").limit(SAMPLE).toArrow()
    points, _ = _widths(matrix(sample.column("v").to_pylist()), np.zeros((0, 1), np.int64))
    tiles = min(TILES, math.ceil(total / BLOCK))
    placed = written(packed.mapInArrow(_deal(tile_cuts(points, tiles), points.shape[1]), _PACKED + ", tile int"), "negatives-tiles")
    spread = F.xxhash64("vec_id", "v")
    # one row per tile: at most twice TILES
    parts = [(r.tile, math.ceil(r.n / BLOCK)) for r in placed.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).collect()]
    n_parts = F.element_at(F.create_map(*[F.lit(x) for pair in parts for x in pair]), F.col("tile"))
    anchors = placed.filter(F.col("vec_id") % every == 0).select("vec_id", "label", "v")
    groups = max(1, math.ceil(anchors.count() / GROUP))
    rows = placed.select(
        F.col("tile").alias("of_tile"), F.pmod(spread, n_parts).cast("int").alias("of_part"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("of_group"),
        F.col("vec_id").alias("other"), F.col("label").alias("other_label"), F.col("v").alias("w"),
    )
    every_tile = F.explode(F.array(*[F.struct(F.lit(t).alias("tile"), F.lit(n).alias("parts")) for t, n in parts]))

    def against_all(queries: DataFrame, same: bool, most_rows: int) -> DataFrame:
        """A group of anchors meets every block of rows; the best of all blocks."""
        asked = queries.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn("t", every_tile)
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("t.parts") - 1)))
        met = asked.groupBy("t.tile", "part", "group").cogroup(rows.groupBy("of_tile", "of_part", "of_group"))
        found = met.applyInArrow(_mine(most_rows, *window, same), "anchor_id long, of long, vec_id long, score long")
        order = Window.partitionBy("anchor_id", "of").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= most_rows)

    first = written(against_all(anchors, True, positives), "negatives-positives")
    listed = first.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("rank").alias("of"), "score")).alias("positives"))
    asked = anchors.join(listed, anchors["vec_id"] == listed["anchor_id"]).drop("anchor_id")
    found = against_all(asked, False, k).select("anchor_id", "of", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = first.select("anchor_id", F.col("rank").alias("of"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(pairs, ["anchor_id", "of"]).select(*(c.split()[0] for c in out.split(", ")))
