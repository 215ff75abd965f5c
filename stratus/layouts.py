"""Schemas and fixed-width layouts of the station-observation files.

Fixed values: the column names, positions (1-based start, length) and
types below follow the published file formats of the daily observation
archive and must stay exactly as written for parsing to be right.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    start: int  # 1-based
    length: int
    dtype: T.DataType = T.StringType()
    align: str = "left"  # how the writer pads it: "left" (text) or "right" (numbers)
    fmt: str | None = None  # printf pattern used when rendering numbers


# --- fixed values: daily observation CSV (no header, comma separated) ---
DAILY_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("DATE", T.DateType()),
        T.StructField("ELEMENT", T.StringType()),
        T.StructField("VALUE", T.FloatType()),
        T.StructField("MFLAG", T.StringType()),
        T.StructField("QFLAG", T.StringType()),
        T.StructField("SFLAG", T.StringType()),
        # read as text; the time of day is derived as OBS_MINUTE
        T.StructField("OBV_TIME", T.StringType()),
    ]
)
DAILY_DATE_FORMAT = "yyyyMMdd"

# --- fixed values: the five core elements ---
CORE_ELEMENTS = ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")

# --- fixed values: station metadata, fixed width ---
STATION_LAYOUT = (
    Field("ID", 1, 11),
    Field("LATITUDE", 13, 8, T.FloatType(), "right", "%8.4f"),
    Field("LONGITUDE", 22, 9, T.FloatType(), "right", "%9.4f"),
    Field("ELEVATION", 32, 6, T.FloatType(), "right", "%6.1f"),
    Field("STATE", 39, 2),
    Field("NAME", 42, 30),
    Field("GFLAG", 73, 3),
    Field("HCFLAG", 77, 3),
    Field("WMOID", 81, 5),
)

# --- fixed values: country and state lookups, fixed width ---
COUNTRY_LAYOUT = (Field("CODE", 1, 2), Field("COUNTRY_NAME", 4, 47))
STATE_LAYOUT = (Field("CODE", 1, 2), Field("STATE_NAME", 4, 47))

# --- fixed values: station x element inventory, fixed width ---
INVENTORY_LAYOUT = (
    Field("ID", 1, 11),
    Field("LAT", 13, 8, T.FloatType(), "right", "%8.4f"),
    Field("LONG", 22, 9, T.FloatType(), "right", "%9.4f"),
    Field("ELEMENT", 32, 4),
    Field("FIRSTYEAR", 37, 4, T.IntegerType(), "right", "%4d"),
    Field("LASTYEAR", 42, 4, T.IntegerType(), "right", "%4d"),
)

# --- fixed values: mean Earth radius used by the distance queries (km) ---
EARTH_RADIUS_KM = 6371.0
