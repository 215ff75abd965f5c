"""Scalar column expressions used across the station and observation jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def country_code(station_id: Column | str = "ID") -> Column:
    """Two-letter country prefix of a station id."""
    return _c(station_id).substr(1, 2)


def trimmed_piece(text: Column | str, start: int, length: int) -> Column:
    """1-based ``substring`` followed by ``trim`` (one fixed-width field)."""
    return F.trim(F.substring(_c(text), start, length))


def year_int(date: Column | str = "DATE") -> Column:
    """Calendar year as int; prefer it over text years so filters can prune."""
    return F.year(_c(date)).cast("int")


def year_text(date: Column | str = "DATE") -> Column:
    """Year as the first four characters of the ISO date text."""
    return F.substring(_c(date).cast("string"), 1, 4)


def array_text(values: Column | str, sep: str = ",") -> Column:
    """Deterministic text form of a set: sorted, joined by ``sep``; a null
    array stays null (``concat_ws`` alone would give '')."""
    arr = _c(values)
    return F.when(arr.isNotNull(), F.concat_ws(sep, F.array_sort(arr)))


def obs_minute(hhmm: Column | str = "OBV_TIME") -> Column:
    """Minute of the day from 24-hour ``HHmm`` text; ``2400`` is end of day.

    Anything that is not four digits, or has minutes >= 60, or hours past
    24 (or 24 with minutes) gives null instead of an error.
    """
    t = F.trim(_c(hhmm))
    hh = F.substring(t, 1, 2).try_cast("int")
    mm = F.substring(t, 3, 2).try_cast("int")
    ok = t.rlike("^[0-9]{4}$") & (mm < 60) & ((hh < 24) | ((hh == 24) & (mm == 0)))
    return F.when(ok, hh * 60 + mm).cast("int")
