"""Exact top-k search by inner product, with cover trees over queries and data.

A bounded sample of the vectors gives the top level's centers.  Queries
and data are assigned to the same centers' cells; a cell knows its covering
radius for either.  For a query cell with center q and radius r and a data
cell with center c and radius s, no inner product exceeds
<q, c> + r |c| + s |q| + r s.  Cell pairs whose bound lies below the query
cell's worst k-th score (against the sample, so a true lower bound) are
pruned.  Cells are dealt into groups and blocks of bounded size; every
remaining pair of a query group and a data block is one task group, where
a cover tree of each is searched with the same bound: node pairs are
pruned against the worst k-th score found in the query node so far.  The
best of all blocks are ranked last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import written

# Production parameters: vectors whose scores give the first bounds, top-level centers at most, rows of a block, of a tree's leaf
SAMPLE, CELLS, BLOCK, LEAF, FANOUT = 4096, 256, 4096, 256, 8


def integer_vectors(column: pa.ListArray, scale: float) -> list[bytes | None]:
    """floor(scale * x) of each vector, packed as 64-bit integers; None where a vector or a component is null or not finite.

    A component beyond 62 bits raises.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lens = np.asarray(column.value_lengths().fill_null(0))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lens)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(scale * values)
    row = np.repeat(np.arange(len(lens)), lens)
    bad = np.bincount(row, ~np.isfinite(values), len(lens)) > 0
    if (np.isfinite(values) & (np.abs(scaled) >= 2.0**62) & ~bad[row]).any():
        raise OverflowError("a scaled component does not fit 62 bits")
    packed = np.where(bad[row], 0, scaled).astype("<i8")
    gone = np.asarray(column.is_null()) | bad
    return [None if gone[i] else packed[ends[i] - lens[i] : ends[i]].tobytes() for i in range(len(lens))]


def matrix(packed: list[bytes]) -> np.ndarray:
    """Rows of packed vectors; shorter ones are filled up with zeros."""
    width = max(map(len, packed), default=0)
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in packed), "<i8").reshape(len(packed), width // 8)


def fits_double(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether every inner product of rows, and every partial sum, is an exact double."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1) < 2.0**53


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``; one beyond 64 bits raises."""
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]
    if fits_double(a, b):
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    # sums wrap modulo 2^64, so a product that fits is right whatever its partial sums were
    size = np.abs(a).astype(np.float64) @ np.abs(b).astype(np.float64).T
    for i, j in np.argwhere(size >= 2.0**62).tolist():
        if not -(2**63) <= sum(x * y for x, y in zip(a[i].tolist(), b[j].tolist())) < 2**63:
            raise OverflowError("an inner product does not fit 64 bits")
    return a @ b.T


class Node:
    """A cover-tree node: center, covering radius, and children or (in a leaf) rows."""

    __slots__ = ("center", "norm", "radius", "children", "rows")

    def __init__(self, center: np.ndarray, radius: float, rows: np.ndarray, children: list[Node]):
        self.center, self.norm, self.radius = center, float(np.sqrt(center @ center)), radius
        self.rows, self.children = rows, children


def cover_tree(x: np.ndarray, rows: np.ndarray | None = None, center: int = 0) -> Node:
    """Cover tree over the points ``x`` (floats), whose numbers are ``rows``; ``center`` is the root's place among them.

    Children are the points picked farthest first, until they cover the
    node at half its radius or there are FANOUT of them; every point goes
    to its nearest one.  Picks go by distances from dot products; the
    covering radius is measured on the differences, so it holds whatever
    was picked.
    """
    rows = np.arange(len(x)) if rows is None else rows
    gap = x - x[center]
    radius = float(np.sqrt(np.einsum("ij,ij->i", gap, gap).max(initial=0.0)))
    if len(rows) <= LEAF or radius == 0:
        return Node(x[center], radius, rows, [])
    norms = np.einsum("ij,ij->i", x, x)
    squares = lambda i: np.maximum(norms - 2 * (x @ x[i]) + norms[i], 0)
    picks, nearest, owner = [center], squares(center), np.zeros(len(rows), np.int64)
    while len(picks) < FANOUT and nearest.max() > radius**2 / 4:
        new = int(nearest.argmax())
        d = squares(new)
        closer = d < nearest
        closer[new] = True  # a picked point is its own child, so every child is smaller than the node
        owner[closer] = len(picks)
        nearest = np.minimum(nearest, d)
        nearest[new] = 0
        picks.append(new)
    children = []
    for k, pick in enumerate(picks):
        part = np.flatnonzero(owner == k)
        if len(part):
            children.append(cover_tree(x[part], rows[part], int(np.flatnonzero(part == pick)[0]) if owner[pick] == k else 0))
    return Node(x[center], radius, rows, children)


def bound(q: Node, d: Node) -> float:
    """No inner product between the nodes' points is larger (with room for rounding)."""
    b = float(q.center @ d.center) + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
    return b + 1e-9 * abs(b) + 1e-6


class Search:
    """Top-k of every query among the data seen so far: scores and ids, worst last."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.queries, self.k = query_ids, queries, k
        self.floor = floor  # scores that k other vectors are known to reach
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(query_ids)
        self.worst = floor.astype(np.float64).copy()
        self.multiply = products

    def leaf_pair(self, rows: np.ndarray, ids: np.ndarray, data: np.ndarray) -> None:
        scores = self.multiply(self.queries[rows], data)
        hit = (scores >= self.worst[rows][:, None]) & (ids[None, :] != self.ids[rows][:, None])
        for i in np.flatnonzero(hit.any(axis=1)):
            take, r = np.flatnonzero(hit[i]), rows[i]
            score, vec = (np.concatenate([old, new[take]]) for old, new in zip(self.best[r], (scores[i].astype(np.int64), ids)))
            order = np.lexsort((vec, -score))[: self.k]
            self.best[r] = score[order], vec[order]
            if len(order) == self.k:
                self.worst[r] = max(self.worst[r], float(score[order[-1]]))

    def run(self, q_root: Node, d_root: Node, ids: np.ndarray, data: np.ndarray) -> None:
        if fits_double(self.queries, data):  # products of floats are exact then, and fast
            self.queries, data, self.multiply = self.queries.astype(np.float64), data.astype(np.float64), lambda a, b: a @ b.T
        todo = [(q_root, d_root)]
        while todo:
            q, d = todo.pop()
            if bound(q, d) < self.worst[q.rows].min():
                continue
            if not q.children and not d.children:
                self.leaf_pair(q.rows, ids[d.rows], data[d.rows])
            elif d.children and (not q.children or d.radius >= q.radius):
                todo += sorted(((q, c) for c in d.children), key=lambda p: bound(*p))
            else:
                todo += sorted(((c, d) for c in q.children), key=lambda p: bound(*p))


def _pack(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = integer_vectors(b.column(1), scale)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], ["vec_id", "v"])

    return run


def _assign(sample_ids: np.ndarray, sample: np.ndarray, cells: int, k: int, every: int):
    centers = sample[:cells].astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "v", "cell", "away", "is_query", "floor"]
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            x = matrix(b.column(1).to_pylist())
            width = max(x.shape[1], centers.shape[1])
            f = np.pad(x.astype(np.float64), ((0, 0), (0, width - x.shape[1])))
            c = np.pad(centers, ((0, 0), (0, width - centers.shape[1])))
            squares = (f**2).sum(axis=1)[:, None] - 2 * f @ c.T + (c**2).sum(axis=1)[None, :]
            cell = squares.argmin(axis=1)
            away = np.sqrt(((f - c[cell]) ** 2).sum(axis=1))
            query = ids % every == 0
            floor = np.full(len(ids), -(2**63), np.int64)
            if query.any():
                scores = products(x[query], sample)
                scores[ids[query][:, None] == sample_ids[None, :]] = -(2**63)
                if scores.shape[1] >= k:
                    floor[query] = np.sort(scores, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cell.astype(np.int32)), pa.array(away), pa.array(query), pa.array(floor)], names
            )

    return run


def _search(k: int):
    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        q, d = matrix(queries.column("v").to_pylist()), matrix(data.column("w").to_pylist())
        width = max(q.shape[1], d.shape[1])
        q, d = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, d))
        ids = data.column("other").to_numpy()
        search = Search(queries.column("vec_id").to_numpy(), q, queries.column("floor").to_numpy(), k)
        if len(q) and len(d):
            search.run(cover_tree(q.astype(np.float64)), cover_tree(d.astype(np.float64)), ids, d)
        rows = [(np.full(len(s), i), v, s) for i, (s, v) in zip(search.ids, search.best)]
        cols = [np.concatenate(c).astype(np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))

    return run


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` best inner products of floor(scale * x).

    Queries are the rows whose id is divisible by ``every``; candidates are
    all rows of another id, ties go to the smaller id.  A vector that is
    null, or has a null or non-finite component, takes no part, nor does a
    null id.  A component beyond 62 bits, or a computed inner product beyond
    64 bits, raises.  Vectors of unequal length
    are compared as if filled up with zeros.  A repeated id is a candidate
    as often as it occurs and has its rows' results ranked together.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    packed = written(rows.mapInArrow(_pack(scale), "vec_id long, v binary").filter("v is not null"), "topk-vectors")
    total = packed.count()
    # at most SAMPLE rows
    sample = packed.orderBy(F.md5(F.col("vec_id").cast("string").cast("binary")), "vec_id", "v").limit(SAMPLE).toArrow()
    out = "query_id long, rank int, vec_id long, score long"
    if not total:
        return spark.createDataFrame([], out)
    points = matrix(sample.column("v").to_pylist())
    cells = min(CELLS, len(points), max(1, math.ceil(total / BLOCK)))
    placed = packed.mapInArrow(
        _assign(sample.column("vec_id").to_numpy(), points, cells, k, every),
        "vec_id long, v binary, cell int, away double, is_query boolean, floor long",
    )
    placed = written(placed, "topk-cells")
    of_query = [F.when(F.col("is_query"), F.col(c)) for c in ("away", "floor")]
    # one row per cell: at most CELLS
    known = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("s"), F.count(of_query[0]).alias("nq"), F.max(of_query[0]).alias("r"), F.min(of_query[1]).alias("floor")
    ).collect()
    c = points[:cells].astype(np.float64)
    pairs = []
    for q in known:
        if q.nq:
            for d in known:
                qc, dc = (Node(c[x.cell], float(rad), np.zeros(0, np.int64), []) for x, rad in ((q, q.r), (d, d.s)))
                if bound(qc, dc) >= q.floor:
                    pairs.append((q.cell, d.cell, max(1, math.ceil(q.nq / BLOCK)), max(1, math.ceil(d.n / BLOCK))))
    near = spark.createDataFrame(pairs, "q_cell int, d_cell int, n_groups int, n_blocks int")
    spread = F.xxhash64("vec_id")
    key = ["q_cell", "d_cell", "part", "block"]
    queries = (
        placed.filter("is_query").withColumnRenamed("cell", "q_cell").join(near, "q_cell")
        .withColumn("part", F.pmod(spread, F.col("n_groups")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select(*key, "vec_id", "v", "floor")
    )
    data = (
        placed.withColumnRenamed("cell", "d_cell").join(near, "d_cell")
        .withColumn("block", F.pmod(spread, F.col("n_blocks")).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1)))
        .select(*[F.col(c).alias(f"of_{c}") for c in key], F.col("vec_id").alias("other"), F.col("v").alias("w"))
    )
    found = queries.groupBy(*key).cogroup(data.groupBy(*[f"of_{c}" for c in key])).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
