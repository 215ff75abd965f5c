"""Rendezvous (highest random weight) sharding of stable record keys.

Native DataFrame functions only.  Every key draws one number per shard
from its own digest; the shard with the highest weighted draw gets the
record.  Adding a shard adds one draw, so a record either stays or moves
to the new shard, and each shard receives its share of the weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import free_name, hex_digits, id_digest, written

# the first 13 hex digits of a digest are 52 bits: exact in a double
_DIGITS = 13
# hex digits of a key's digest
_DIGEST = 32
# a bucket this many times its intended size holds ids that repeat, and is cut finer
_OVERFULL = 4


def draw(key: F.Column, shard: F.Column) -> F.Column:
    """A number in (0, 1) that key and shard decide."""
    digest = F.md5(F.concat(key, F.lit("/"), shard.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / float(16**_DIGITS)


def best_draw(key: F.Column, weights: Sequence[float], first: int = 0) -> F.Column:
    """The highest draw among the shards from ``first`` on: a struct of its score and -shard (ties: the smaller shard)."""
    of = F.array(*[F.lit(float(w)) for w in weights])
    return F.array_max(
        F.transform(
            F.sequence(F.lit(first), F.lit(len(weights) - 1)),
            lambda s: F.struct((F.get(of, s) / -F.log(draw(key, s))).alias("score"), (-s).alias("s")),
        )
    )


def _checked(weights: Sequence[float]) -> list[float]:
    if not weights or min(weights) < 0 or not 0 < sum(weights) < float("inf"):
        raise ValueError("weights must be finite, not negative and not all zero")
    return [float(w) for w in weights]


def rendezvous_shard(key: F.Column, weights: Sequence[float]) -> F.Column:
    """The shard (int from 0) of a text key; ties go to the smaller shard.

    A weight of 0 takes no record; weights must be finite, not negative
    and not all 0.
    """
    return (-best_draw(key, _checked(weights))["s"]).cast("int")


def labelled(placed: DataFrame, shard: str, order: str, shards: int, per_bucket: int, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``placed`` with a label, and the rows per ``shard`` and label; ``names`` of label, rows and a helper column.

    A label is a prefix of ``order`` (the key's digest and digits of the
    row's own), so labels sort like the rows.  It is as long as cuts all
    rows into buckets of about ``per_bucket``; in a bucket that ids
    repeated very often have overfilled, it names the digest and as many of
    the row's own digits as its size asks for.
    """
    label, n, wide = names
    digits = hex_digits(placed.count(), per_bucket * shards)
    prefix = F.substring(order, 1, digits)
    sizes = placed.groupBy(shard, prefix.alias(label)).agg(F.count(F.lit(1)).alias(n))
    sizes = written(sizes, "shard-sizes")
    over = sizes.filter(F.col(n) > _OVERFULL * per_bucket)
    over = over.select(shard, label, (F.ceil(F.log(16.0, F.col(n) / per_bucket)) + _DIGEST).cast("int").alias(wide))
    rows = placed.withColumn(label, prefix).join(over, [shard, label], "left")
    rows = rows.withColumn(label, F.col(order).substr(F.lit(1), F.coalesce(wide, F.lit(digits))))
    fine = rows.filter(F.col(wide).isNotNull()).groupBy(shard, label).agg(F.count(F.lit(1)).alias(n))
    return rows.drop(wide), sizes.filter(F.col(n) <= _OVERFULL * per_bucket).unionByName(fine)


def shard_rows(
    docs: DataFrame,
    weights: Sequence[float],
    grown: Sequence[float] | None = None,
    id_col: str = "doc_id",
    per_bucket: int = 100_000,
) -> DataFrame:
    """``docs`` with shard (int), slot (long, gapless from 0 in each shard) and grown_shard.

    ``grown`` are the weights after shards were added at the end
    (grown_shard is null without them).  The key is the id's text; null
    ids share a key and so a shard, repeated ids get slots of their own, in
    no stated order among themselves.  The numbering never sorts a whole
    shard in one task: rows are counted per (shard, leading digits of the
    key's digest), the counts become offsets, and rows are numbered inside
    such buckets.  An id that very many rows repeat (a null id, say) is cut
    into buckets of the same size.  Texts are carried, not read, so their
    length does not matter.  An empty table gives an empty result.  Added
    columns get a trailing underscore where the input has a column of that
    name.
    """
    old = _checked(weights)
    added = ("shard", "slot", "grown_shard", "_best", "_order", "_before", "_label", "_n", "_wide")
    shard, slot, grow, best, order, before, *helpers = (free_name(docs.columns, n) for n in added)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    more = F.lit(None)
    if grown:
        new = _checked(grown)
        # shards that are as before have made their draws
        same = new[: len(old)] == old
        more = F.greatest(F.col(best), best_draw(key, new, len(old))) if same and len(new) > len(old) else best_draw(key, new)
        more = -more["s"]
    # the row's number decides nothing but the order of rows that repeat an id; the written table holds it fast
    own = F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0")
    placed = docs.withColumns({best: best_draw(key, old), order: F.concat(id_digest(id_col), own)})
    placed = placed.withColumns({shard: (-F.col(best)["s"]).cast("int"), grow: more.cast("int")}).drop(best)
    rows, sizes = labelled(written(placed, "shard-rows"), shard, order, len(old), per_bucket, helpers)
    label, n = helpers[:2]
    offsets = sizes.withColumn(before, F.sum(n).over(Window.partitionBy(shard).orderBy(label)) - F.col(n)).drop(n)
    within = Window.partitionBy(shard, label).orderBy(order)
    return (
        rows.withColumn(slot, F.row_number().over(within).cast("long") - 1)
        .join(offsets, [shard, label])
        .withColumn(slot, F.col(slot) + F.col(before))
        .select(*docs.columns, shard, slot, grow)
    )
