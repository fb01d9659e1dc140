"""Positional schemas of the three delimited datasets.

Fields are bound by position, never by header name; every field is
nullable. Trip start/end are zone-free timestamps (the text carries no zone);
``TRIP_DATE_SCHEMA`` is the variant that keeps only the calendar day.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Field names, order and types of the three datasets.
STATION_SCHEMA = _schema([
    ("station_id", IntegerType()),
    ("station_name", StringType()),
    ("lat", FloatType()),
    ("long", FloatType()),
    ("dock_ct", IntegerType()),
    ("city", StringType()),
    ("install_dt", DateType()),
])

WEATHER_SCHEMA = _schema([
    ("Date", DateType()),
    ("max_temp", IntegerType()),
    ("mean_temp", IntegerType()),
    ("min_temp", IntegerType()),
    ("max_dp", IntegerType()),
    ("mean_dp", IntegerType()),
    ("min_dp", IntegerType()),
    ("max_humidity", IntegerType()),
    ("mean_humidity", IntegerType()),
    ("min_humidity", IntegerType()),
    ("max_pressure", FloatType()),
    ("mean_pressure", FloatType()),
    ("min_pressure", FloatType()),
    ("max_visibility", IntegerType()),
    ("mean_visibility", IntegerType()),
    ("min_visibility", IntegerType()),
    ("max_ws", IntegerType()),
    ("mean_ws", IntegerType()),
    ("max_gust", IntegerType()),
    ("precipitation", FloatType()),
    ("cloud_cover", IntegerType()),
    ("events", StringType()),
    ("wind_dir", IntegerType()),
    ("zip_code", StringType()),
])

# trip_id is wider than in the original files, so that keys beyond 32 bits are not lost.
TRIP_SCHEMA = _schema([
    ("trip_id", LongType()),
    ("duration", IntegerType()),
    ("start_date", TimestampNTZType()),
    ("start_station", StringType()),
    ("start_terminal", IntegerType()),
    ("end_date", TimestampNTZType()),
    ("end_station", StringType()),
    ("end_terminal", IntegerType()),
    ("bike_no", IntegerType()),
    ("sub_type", StringType()),
    ("zip", StringType()),
])

# Field metadata key naming the strptime format a field's text is read with,
# when it differs from the default for its type.
TEXT_FORMAT = "text_format"

# Trip dates are always written with a time of day; in the date-typed
# variant they are read as date and time, and only the day is kept.
TRIP_DATE_SCHEMA = StructType([
    StructField(f.name, DateType(), True, {TEXT_FORMAT: "%m/%d/%Y %H:%M"})
    if isinstance(f.dataType, TimestampNTZType) else f
    for f in TRIP_SCHEMA.fields
])

# The four text fields a usable trip must have filled in.
TRIP_REQUIRED_TEXT = ["start_station", "end_station", "sub_type", "zip"]
