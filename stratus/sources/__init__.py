"""Readers and writers: delimited gzip text, fixed-width text, Parquet lake."""

from stratus.sources.daily import (  # noqa: F401
    daily_rejects,
    read_daily_csv,
    read_untyped_csv,
    with_obs_minute,
    write_daily_archive,
)
from stratus.sources.files import file_inventory, inventory_totals  # noqa: F401
from stratus.sources.fixed_width import (  # noqa: F401
    fixed_width_rejects,
    parse_fixed_width,
    read_fixed_width,
    render_fixed_width,
    render_overflows,
)
from stratus.sources.lake import read_observation_lake, write_observation_lake  # noqa: F401
from stratus.sources.sinks import (  # noqa: F401
    reconcile_csv,
    write_counted,
    write_csv,
    write_single_file,
    write_sorted,
)
