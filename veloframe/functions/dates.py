"""Calendar features (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day classes. Monday is 0 ... Sunday is 6; 0-4 are weekdays.
WEEKDAY = "weekday"
WEEKEND = "weekend"
LAST_WEEKDAY = 4


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day_number(ts) -> Column:
    """Weekday number, Monday 0 ... Sunday 6 (NULL stays NULL)."""
    return F.weekday(_c(ts))


def day_class(day) -> Column:
    """'weekday' for day numbers 0-4, 'weekend' for 5-6, NULL for NULL."""
    d = _c(day)
    return F.when(d <= LAST_WEEKDAY, F.lit(WEEKDAY)).when(d.isNotNull(), F.lit(WEEKEND))


def days_between(end, start) -> Column:
    """Whole calendar days from ``start`` to ``end``; time of day ignored."""
    return F.datediff(_c(end), _c(start))
