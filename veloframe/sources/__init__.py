"""Sources and sinks: schemas, delimited text, catalog tables, fixture views."""

from veloframe.sources.catalog import cut_lineage, keep, read_table, save_table
from veloframe.sources.ingest import load_delimited, parse_lines, read_lines
from veloframe.sources.schemas import (
    STATION_SCHEMA,
    TRIP_DATE_SCHEMA,
    TRIP_REQUIRED_TEXT,
    TRIP_SCHEMA,
    WEATHER_SCHEMA,
)

__all__ = [
    "load_delimited", "parse_lines", "read_lines", "save_table", "read_table", "keep",
    "cut_lineage", "STATION_SCHEMA", "WEATHER_SCHEMA", "TRIP_SCHEMA", "TRIP_DATE_SCHEMA",
    "TRIP_REQUIRED_TEXT",
]
