"""DataFrame -> DataFrame operators."""

from veloframe.operators.features import (
    group_class_shares,
    trip_features,
    with_day_of_week,
    with_days_between,
    with_equal_flag,
    with_group_average,
    with_group_shares,
    with_station_features,
)
from veloframe.operators.relational import (
    attach,
    class_counts,
    first_rows,
    group_count,
    non_empty,
    part_counts,
    stack,
    stack_tagged,
)

__all__ = [
    "group_class_shares", "trip_features", "with_day_of_week", "with_days_between",
    "with_equal_flag", "with_group_average", "with_group_shares", "with_station_features",
    "attach", "class_counts", "first_rows", "group_count", "non_empty", "part_counts",
    "stack", "stack_tagged",
]
