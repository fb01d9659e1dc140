"""Column -> Column helpers: safe casts, calendar features, flags, shares."""

from veloframe.functions.casts import (
    safe_date,
    safe_datetime,
    safe_double,
    safe_float,
    safe_fractional_timestamp,
    safe_int,
    safe_long,
)
from veloframe.functions.compare import equal_flag, share
from veloframe.functions.dates import day_class, day_number, days_between

__all__ = [
    "safe_int", "safe_long", "safe_double", "safe_float", "safe_date", "safe_datetime",
    "safe_fractional_timestamp", "equal_flag", "share", "day_number", "day_class",
    "days_between",
]
