"""Column-level building blocks (all native Spark expressions)."""

from stratus.functions.columns import (  # noqa: F401
    array_text,
    country_code,
    obs_minute,
    trimmed_piece,
    year_int,
    year_text,
)
from stratus.functions.geo import haversine_km, unit_xyz_km  # noqa: F401
