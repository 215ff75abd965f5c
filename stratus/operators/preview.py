"""First rows of a table as text, for a look at it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column's name as ``F.col`` takes it, whatever stands in it (dots, slashes, blanks, backticks)."""
    return "`" + name.replace("`", "``") + "`"


def cell(name: str, width: int = 20) -> Column:
    """A value as text: nulls as ``NULL``, more than ``width`` characters cut to end in ``...``."""
    text = F.coalesce(F.col(quoted(name)).cast("string"), F.lit("NULL"))
    short = F.concat(F.substring(text, 1, width - 3), F.lit("...")) if width > 3 else F.substring(text, 1, width)
    return F.when(F.length(text) > width, short).otherwise(text).alias(name)


def preview(df: DataFrame, order: Sequence[str], rows: int = 20, width: int = 20) -> DataFrame:
    """The first ``rows`` rows of ``df`` by ``order``, every cell as text.

    Give a total order: rows that tie in it may change places.  Spark keeps
    ``rows`` rows per task and merges them (TakeOrderedAndProject), so no
    table is sorted for it.  An empty table stays empty.
    """
    first = df.orderBy(*[quoted(c) for c in order]).limit(rows)
    return first.select(*[cell(c, width) for c in df.columns])
