"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are laid end to end in shuffled order (by the
digest of id and text) and cut into blocks of equally many words.  Slot j of
the mix draws the point j * golden ratio (modulo 1, in 32-bit integers),
whose place in the cumulative targets names a source; the rank r of the
slot among its source's slots names the block: r modulo the number of
blocks, in pass r div blocks.  Any stretch of slots holds the sources
close to their targets, and no random state is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import hex_digits, word_count, written

# 2^32 divided by the golden ratio, and the unit interval's cells
_STEP = 2654435769
_ONE = 2**32
_CELLS = 4096
_CHUNK = 2**16

# Production parameter: words of a block
BLOCK = 256


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, target: ``share`` of all words, dealt by weight.

    ``sizes`` has one row per source (source, source_size).  Sources take
    the weights in turn by code point, null last.  A target stops at
    ``most`` times its source's size; the excess goes to the others by
    weight until none is above: target = min(most * size, level * weight)
    for the one level at which the targets add up (``share`` <= ``most``).
    """
    everything = Window.partitionBy()  # one small row per source
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn % len(weights)))
    s = s.withColumn("fills_at", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    fill = Window.orderBy(F.col("fills_at"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(F.col("fills_at"), F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = (share * total - most * F.coalesce(F.sum("source_size").over(fill), F.lit(0))) / F.sum("weight").over(onward)
    s = s.withColumn("level", level)
    s = s.withColumn("level", F.max(F.when(F.col("level") <= F.col("fills_at"), F.col("level"))).over(everything))
    return s.select(
        "source",
        "source_size",
        F.least(F.lit(float(most)) * F.col("source_size"), F.col("level") * F.col("weight")).alias("target"),
    )


def row_digest(id_col: str, text_col: str) -> Column:
    """A row's position in the shuffled order: a digest of its id and text, so rows that share an id are spread as well."""
    told = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.md5(F.concat(told, F.lit("/"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).cast("binary"))


def stream_positions(docs: DataFrame, per_bucket: int = 4096) -> DataFrame:
    """``docs`` (doc_id, source, size, digest, ...) with start: words of its source before it, in the order of the digests.

    A two-level sum: per (source, leading digits of the digest), then
    inside such a bucket, so no source is summed by one task.  Rows without
    words all start at 0; they take no place and are not sorted.
    """
    empty = docs.filter("size = 0").withColumn("start", F.lit(0).cast("long")).drop("digest")
    docs = docs.filter("size > 0")
    digits = hex_digits(docs.count(), per_bucket)
    d = docs.withColumn("bucket", F.substring("digest", 1, digits))
    key = ["source_key", "bucket"]
    d = d.withColumn("source_key", F.struct("source"))  # a key that holds null
    sums = (
        d.groupBy(*key)
        .agg(F.sum("size").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("source_key").orderBy("bucket")) - F.col("n"))
        .drop("n")
    )
    inside = Window.partitionBy(*key).orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("start", F.sum("size").over(inside) - F.col("size")).join(sums, key)
    return d.withColumn("start", F.col("start") + F.col("before")).drop("digest", "before", *key).unionByName(empty)


def slot_schedule(targets: DataFrame, block: int) -> DataFrame:
    """slot, source, rank, pass, block_no and words (how many of the block's first words the slot takes).

    A source's share of the slots is what its target needs, partial last
    blocks included.  The schedule runs a little longer than that, for
    sources that the points serve late; ranks that a source still lacks then
    come as last slots, ranks beyond its target are left out, and its last
    rank stops where the target is reached.  So every source gives its
    target, rounded up to a whole word.
    """
    spark = targets.sparkSession
    order = Window.orderBy(F.col("source").asc_nulls_last())
    whole = F.floor(F.col("target") / F.col("source_size"))
    rest = F.ceil((F.col("target") - whole * F.col("source_size")) / block)
    t = targets.filter("target > 0").withColumn("need", whole * F.ceil(F.col("source_size") / block) + rest)
    need = t.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]
    t = t.withColumn("upto", F.sum("need").over(order)).withColumn("hi", F.floor(F.col("upto") / F.lit(float(need)) * _ONE))
    t = t.withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0)))
    width = _ONE // _CELLS
    cells = t.filter("hi > lo").select(
        "source", "source_size", "target", "lo", "hi",
        F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))).alias("cell"),
    )
    extent = need + need // 50 + 16
    slots = spark.range(extent).select(F.col("id").alias("slot"), (F.col("id") % _ONE * _STEP % _ONE).alias("point"))
    slots = slots.withColumn("cell", F.expr(f"point div {width}")).join(cells, "cell").filter("point >= lo and point < hi")
    slots = slots.withColumns({"source_key": F.struct("source"), "chunk": F.expr(f"slot div {_CHUNK}")})
    counts = slots.groupBy("source_key", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("source_key").orderBy("chunk")) - F.col("n")).drop("n")
    inside = Window.partitionBy("source_key", "chunk").orderBy("slot")
    slots = slots.withColumn("rank", F.row_number().over(inside) - 1).join(before, ["source_key", "chunk"])
    slots = slots.withColumn("rank", F.col("rank") + F.col("before"))
    served = counts.groupBy("source_key").agg(F.sum("n").alias("served"))
    late = t.withColumn("source_key", F.struct("source")).join(served, "source_key", "left").fillna(0, ["served"]).filter("served < need")
    late = late.withColumn("rank", F.explode(F.sequence("served", F.col("need") - 1)))
    late = late.withColumn("slot", extent + F.col("upto") - F.col("need") + F.col("rank"))  # a range of its own per source
    columns = ["slot", "source_key", "source_size", "target", "rank"]
    slots = slots.select(*columns).unionByName(late.select(*columns))
    blocks = F.ceil(F.col("source_size") / block)
    slots = slots.withColumns({"pass": F.floor(F.col("rank") / blocks), "block_no": F.col("rank") % blocks})
    # words of the target that earlier ranks have taken: whole passes and whole blocks
    earlier = F.col("pass") * F.col("source_size") + F.col("block_no") * block
    held = F.least(F.lit(block).cast("long"), F.col("source_size") - F.col("block_no") * block)
    slots = slots.withColumn("words", F.least(held, F.ceil(F.col("target")) - earlier)).filter("words > 0")
    return slots.select("slot", "source_key", "rank", "pass", "block_no", "words")


class Mix:
    """The parts of one mix: ``docs`` with their place in their source's stream, ``targets`` and ``slots``."""

    def __init__(self, docs: DataFrame, targets: DataFrame, slots: DataFrame, block: int):
        self.docs, self.targets, self.slots, self.block = docs, targets, slots, block

    def pieces(self, how: str = "inner") -> DataFrame:
        """The columns of ``docs`` and slot, pass, from_word, to_word for every part of a document that a slot takes.

        Documents without words have no part.  ``how="left"`` also has a row for parts that no slot takes (slot null).
        """
        last = F.col("start") + F.col("size") - 1
        d = self.docs.filter("size > 0").withColumn("block_no", F.explode(F.sequence(F.expr(f"start div {self.block}"), F.floor(last / self.block))))
        d = d.withColumn("source_key", F.struct("source")).join(self.slots, ["source_key", "block_no"], how)
        lo = F.greatest(F.col("start"), F.col("block_no") * self.block) - F.col("start")
        hi = F.least(F.col("start") + F.col("size"), F.col("block_no") * self.block + F.col("words")) - F.col("start")
        d = d.withColumns({"from_word": lo, "to_word": hi}).drop("source_key", "block_no", "rank", "words")
        return d if how == "left" else d.filter("to_word > from_word")

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken: one row per row of ``docs``."""
        words = F.when(F.col("slot").isNotNull(), F.greatest(F.col("to_word") - F.col("from_word"), F.lit(0)))
        row = ["doc_id", "source", "size", "start"]  # a row with words has a start of its own
        t = self.pieces("left").groupBy(*row).agg(F.coalesce(F.sum(words), F.lit(0)).cast("long").alias("taken"))
        t = t.unionByName(self.docs.filter("size = 0").select(*row, F.lit(0).cast("long").alias("taken")))
        s = self.targets.withColumnRenamed("source", "of")
        t = t.join(s, F.col("source").eqNullSafe(F.col("of")))
        return t.select("doc_id", "size", "source_size", "target", "taken", "source")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2,
    block: int = BLOCK,
    carry: Sequence[str] = (),
) -> Mix:
    """Plans the mix of ``docs`` (doc_id, text, source, and the columns named in ``carry``).

    Sizes are word counts; a null or blank text has none and is never
    taken.  A block holds ``block`` words whatever the size of the corpus;
    the last slot of a source stops at its target, rounded up to a word.  No
    document is taken more than ``most`` times (a whole number of passes).
    Sources may be null; an empty table gives empty parts.  Null and
    repeated ids are spread by the text; rows that repeat id and text stand
    next to each other and are taken alike.  A carried column must not have
    one of the names size, digest, start, bucket and source_key.
    """
    if share > most or most != int(most):
        raise ValueError("share must not exceed most, a whole number")
    if {c.lower() for c in carry} & {"size", "digest", "start", "bucket", "source_key", "doc_id", "source"}:
        raise ValueError("a carried column clashes with the columns of the mix")
    size, digest = word_count(F.col("text")).alias("size"), row_digest("doc_id", "text").alias("digest")
    sized = written(docs.select("doc_id", "source", size, digest, *carry), "mix-sizes")
    targets = written(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets"
    )
    return Mix(stream_positions(sized), targets, slot_schedule(targets, block), block)
