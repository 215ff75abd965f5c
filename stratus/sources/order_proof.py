"""Proof that written files are globally sorted, in one pass and without a sort.

Every task tells, for each part of a file it reads, the first and the last
key and whether the keys in between ascend.  The parts, in the order of
file names and places, are compared with their neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ascends(a: Sequence[pa.Array], b: Sequence[pa.Array]) -> bool:
    """Whether every row of ``a`` comes before or equals the same row of ``b``; nulls come first."""
    right, equal = pa.array([False] * len(a[0])), pa.array([True] * len(a[0]))
    for x, y in zip(a, b):
        less = pc.or_(pc.and_(x.is_null(), y.is_valid()), pc.fill_null(pc.less(x, y), False))
        same = pc.or_(pc.and_(x.is_null(), y.is_null()), pc.fill_null(pc.equal(x, y), False))
        right = pc.or_(right, pc.and_(equal, less))
        equal = pc.and_(equal, same)
    return pc.all(pc.or_(right, equal), min_count=0).as_py()


def _parts(n_keys: int):
    """Rows (file, block, keys...) in file order to one row per file part; the state is one row."""
    names = ["file", "block", "n_rows", "ascending", *[f"first_{i}" for i in range(n_keys)], *[f"last_{i}" for i in range(n_keys)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None  # the part that the rows are in

        def told(part: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part["file"]]), pa.array([part["block"]], pa.int64()), pa.array([part["rows"]], pa.int64()), pa.array([part["ascending"]]),
                 *part["first"], *part["last"]], names,
            )

        for b in batches:
            at = 0
            while at < b.num_rows:
                file, block = b.column(0)[at].as_py(), b.column(1)[at].as_py()
                here = pc.and_(pc.equal(b.column(0), file), pc.equal(b.column(1), block)).slice(at)
                gone = pc.index(here, False).as_py()
                n = gone if gone >= 0 else len(here)
                keys = [c.slice(at, n) for c in b.columns[2:]]
                first, last = [k.slice(0, 1) for k in keys], [k.slice(n - 1, 1) for k in keys]
                inside = _ascends([k.slice(0, n - 1) for k in keys], [k.slice(1) for k in keys]) if n > 1 else True
                if held and (held["file"], held["block"]) == (file, block):
                    held["ascending"] = held["ascending"] and inside and _ascends(held["last"], first)
                    held["rows"] += n
                    held["last"] = last
                else:
                    if held:
                        yield told(held)
                    held = {"file": file, "block": block, "rows": n, "ascending": inside, "first": first, "last": last}
                at += n
        if held:
            yield told(held)

    return run


def file_parts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per file part that holds rows: file, block, n_rows, ascending, first and last (structs of the keys).

    ``rows`` must come straight from a file reader, so that a task's rows
    stand in file order.
    """
    kinds = [rows.schema[k].dataType.simpleString() for k in keys]
    fields = "".join(f", first_{i} {t}" for i, t in enumerate(kinds)) + "".join(f", last_{i} {t}" for i, t in enumerate(kinds))
    given = rows.select(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), *keys)
    parts = given.mapInArrow(_parts(len(keys)), "file string, block long, n_rows long, ascending boolean" + fields)
    ends = [F.struct(*[F.col(f"{e}_{i}").alias(f"k{i}") for i in range(len(keys))]).alias(e) for e in ("first", "last")]
    return parts.select("file", "block", "n_rows", "ascending", *ends)


def _compared(parts: DataFrame) -> DataFrame:
    """``parts`` with the last key of the part before, and whether a part stands wrong.

    One small row per file part meets its neighbour; no row is sorted.
    """
    before = F.lag("last").over(Window.orderBy("file", "block"))
    follows = F.coalesce(F.col("first") >= F.col("before"), F.lit(True))
    return parts.withColumn("before", before).withColumn("wrong", ~F.col("ascending") | ~follows)


def disorders(parts: DataFrame) -> DataFrame:
    """The parts whose keys do not ascend, or whose first key comes before the last one of the part before."""
    return _compared(parts).filter("wrong").drop("wrong")


def order_proof(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: data_rows, and whether all files together are in the order of the keys."""
    found = _compared(file_parts(rows, keys))
    total = F.coalesce(F.sum("n_rows"), F.lit(0)).alias("data_rows")
    return found.agg(total, (F.count_if("wrong") == 0).alias("in_order"))
