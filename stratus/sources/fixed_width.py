"""Fixed-width text: a layout (tuple of ``Field``) drives both directions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.columns import trimmed_piece
from stratus.layouts import Field


def parse_fixed_width(text: DataFrame, layout: tuple[Field, ...], line_col: str = "value") -> DataFrame:
    """One projection of substring/trim/try_cast per field.

    Blank text fields stay ``''`` (as the archive tools give them); blank
    or malformed numbers become null through ``try_cast`` rather than
    failing the job under ANSI casting.
    """
    line = F.col(line_col)
    cols = []
    for f in layout:
        piece = trimmed_piece(line, f.start, f.length)
        cols.append((piece if f.dtype.simpleString() == "string" else piece.try_cast(f.dtype)).alias(f.name))
    return text.select(*cols)


def read_fixed_width(spark: SparkSession, path: str, layout: tuple[Field, ...]) -> DataFrame:
    """``spark.read.text`` + ``parse_fixed_width``; splittable, no schema inference."""
    return parse_fixed_width(spark.read.text(path), layout)


def _rendered(df: DataFrame, f: Field):
    """Text of one field before padding, null where there is no value."""
    src = F.col(f.name)
    return F.when(src.isNotNull(), F.format_string(f.fmt, src)) if f.fmt else src.cast("string")


def render_fixed_width(df: DataFrame, layout: tuple[Field, ...]) -> DataFrame:
    """Inverse of ``parse_fixed_width``: one ``value`` line per row.

    Numbers are printed with the field's printf pattern and right-aligned,
    text is left-aligned; every field is padded to its width and placed at
    its start column.  Missing columns and nulls render as blanks.  A value
    that does not fit its field raises: nothing is cut
    (``render_overflows`` counts such values beforehand).
    """
    parts = []
    pos = 1
    for f in sorted(layout, key=lambda x: x.start):
        if f.start > pos:
            parts.append(F.lit(" " * (f.start - pos)))
        if f.name in df.columns:
            txt = _rendered(df, f)
            told = F.concat(F.lit(f"{f.name} does not fit {f.length} characters: "), txt)
            txt = F.when(F.length(txt) > f.length, F.raise_error(told).cast("string")).otherwise(F.coalesce(txt, F.lit("")))
            txt = F.lpad(txt, f.length, " ") if f.align == "right" else F.rpad(txt, f.length, " ")
        else:
            txt = F.lit(" " * f.length)
        parts.append(txt)
        pos = f.start + f.length
    return df.select(F.concat(*parts).alias("value"))


def render_overflows(df: DataFrame, layout: tuple[Field, ...]) -> DataFrame:
    """One row: how many values per field would not fit (``<FIELD>_overflows``)."""
    present = [f for f in layout if f.name in df.columns]
    return df.agg(*[F.count_if(F.length(_rendered(df, f)) > f.length).alias(f"{f.name}_overflows") for f in present])


def fixed_width_rejects(text: DataFrame, layout: tuple[Field, ...], line_col: str = "value") -> DataFrame:
    """Rows whose typed fields hold text that does not parse, per field.

    ``parse_fixed_width`` turns such values into null (``try_cast``); this
    counts them in one aggregate pass so bad input is visible instead of
    silently null.  Blank fields are missing values, not rejects.  One row:
    ``lines`` plus one ``<FIELD>_rejects`` column per typed field.
    """
    line = F.col(line_col)
    aggs = [F.count(F.lit(1)).alias("lines")]
    for f in layout:
        if f.dtype.simpleString() == "string":
            continue
        piece = trimmed_piece(line, f.start, f.length)
        bad = (piece != "") & piece.try_cast(f.dtype).isNull()
        aggs.append(F.count_if(bad).alias(f"{f.name}_rejects"))
    return text.agg(*aggs)
