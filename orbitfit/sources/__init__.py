"""Sources: parquet tables with pruned projections, stable CSV reads, generated data."""

from orbitfit.sources.tables import (
    LINEITEM_KEYS,
    table,
    lineitem_points,
    part_regression,
    line_dataset,
)
from orbitfit.sources.csv import (
    LOCATION_SCHEMA,
    LOCATION_TIME_FORMAT,
    read_csv_stable,
    write_location_csv,
    set_time_parser_policy,
)
