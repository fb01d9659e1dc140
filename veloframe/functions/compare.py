"""Comparison and rounding helpers (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def equal_flag(a, b) -> Column:
    """1 when both values are equal, else 0. NULL equals NULL (gives 1)."""
    return _c(a).eqNullSafe(_c(b)).cast("int")


def share(part, total, scale: int = 2) -> Column:
    """``round(part / total, scale)`` with HALF_UP rounding, as double.

    Both counts are taken as exact decimals, so the quotient carries 18
    fraction digits before it is rounded: far more than a count can need.
    """
    q = _c(part).cast("decimal(20,0)") / _c(total).cast("decimal(20,0)")
    return F.round(q, scale).cast("double")
