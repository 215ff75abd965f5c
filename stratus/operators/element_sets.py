"""Element sets of stations as bit masks: all questions from one hash aggregate.

``collect_set`` keeps a set object per station and task.  Here an element
is a bit, a set is as many 64-bit words as the vocabulary needs, and a
station's words are ORed: fixed-size states in the hash aggregate, and
counts, tests and lists are arithmetic on the words.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 64


def element_vocabulary(inventory: DataFrame, column: str = "ELEMENT", most: int = 4096) -> list[str]:
    """The elements that occur, in order.  A vocabulary, not data: more than ``most`` raise."""
    names = [r[0] for r in inventory.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} elements: not a vocabulary")
    return sorted(names)


class ElementMasks:
    """Bit positions of a vocabulary, and questions on the words ``w0``, ``w1``, ... of a set."""

    def __init__(self, names: Sequence[str]):
        self.names = sorted(set(names))
        self.at = {e: divmod(i, _BITS) for i, e in enumerate(self.names)}
        self.words = [f"w{j}" for j in range(max(1, -(-len(self.names) // _BITS)))]

    def masks(self, inventory: DataFrame, key: str = "ID", column: str = "ELEMENT") -> DataFrame:
        """``key`` and the words of its set.  Null elements are in no set; an element outside the vocabulary raises."""
        spark = inventory.sparkSession
        bits = spark.createDataFrame([(e, j, b) for e, (j, b) in self.at.items()], "_e string, _word int, _bit int")
        rows = inventory.select(key, F.col(column).alias("_element")).join(bits, F.col("_element") == F.col("_e"), "left")
        unknown = F.col("_e").isNull() & F.col("_element").isNotNull()
        told = F.raise_error(F.concat(F.lit("element outside the vocabulary: "), F.col("_element"))).cast("long")
        one = F.when(unknown, told).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit")))
        words = [F.coalesce(F.bit_or(F.when(unknown | (F.col("_word") == j), one)), F.lit(0).cast("long")).alias(w) for j, w in enumerate(self.words)]
        return rows.groupBy(key).agg(*words)

    def mask(self, elements: Sequence[str]) -> list[int]:
        """The words of a set of elements of the vocabulary, as signed 64-bit integers."""
        out = [0] * len(self.words)
        for e in elements:
            j, b = self.at[e]
            out[j] |= 1 << b
        return [x - (1 << _BITS) if x >> (_BITS - 1) else x for x in out]

    def _each(self, elements: Sequence[str]) -> list[tuple[Column, Column]]:
        return [(F.col(w), F.lit(m).cast("long")) for w, m in zip(self.words, self.mask([e for e in elements if e in self.at]))]

    def size(self) -> Column:
        """How many elements the set has."""
        return functools.reduce(operator.add, [F.bit_count(w) for w in self.words]).cast("long")

    def among(self, elements: Sequence[str]) -> Column:
        """How many of ``elements`` are in the set."""
        return functools.reduce(operator.add, [F.bit_count(w.bitwiseAND(m)) for w, m in self._each(elements)]).cast("long")

    def has_all(self, elements: Sequence[str]) -> Column:
        """Whether the set holds every one of ``elements`` (never, if one is outside the vocabulary)."""
        if not set(elements) <= set(self.at):
            return F.lit(False)
        return functools.reduce(operator.and_, [w.bitwiseAND(m) == m for w, m in self._each(elements)])

    def is_only(self, element: str) -> Column:
        """Whether the set is exactly that element."""
        if element not in self.at:
            return F.lit(False)
        return functools.reduce(operator.and_, [w == m for w, m in self._each([element])])

    def listed(self) -> Column:
        """The set's elements in order, as an array."""
        present = [F.when(F.getbit(F.col(self.words[j]), F.lit(b)) == 1, F.lit(e)) for e, (j, b) in self.at.items()]
        return F.array_compact(F.array(*present)) if present else F.array().cast("array<string>")


def element_profile(inventory: DataFrame, core: Sequence[str], only: str, names: Sequence[str] | None = None) -> DataFrame:
    """ID, element_count, core_count, other_count, all_core, only_one and element_list of every station, in one aggregate."""
    m = ElementMasks(names if names is not None else element_vocabulary(inventory))
    return m.masks(inventory).select(
        "ID",
        m.size().alias("element_count"),
        m.among(core).alias("core_count"),
        (m.size() - m.among(core)).alias("other_count"),
        m.has_all(core).alias("all_core"),
        m.is_only(only).alias("only_one"),
        m.listed().alias("element_list"),
    )
