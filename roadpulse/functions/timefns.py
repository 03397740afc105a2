"""Time expressions (zone-free on TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_minutes(ts: str | Column, minutes: int) -> Column:
    """Floor a timestamp to an epoch-aligned ``minutes`` grid (clock-aligned
    for any divisor of 60). Same result as a tumbling ``window(...).start``
    but usable more than once per projection."""
    if minutes <= 0:
        raise ValueError("minutes must be positive")
    us = int(minutes) * 60 * 1_000_000
    ts = _c(ts)
    # Offset from the grid, measured on the wall clock (a no-op cast for NTZ);
    # subtracting it keeps the input's timestamp type.
    diff = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts.cast("timestamp_ntz"))
    return F.timestamp_add("MICROSECOND", -F.pmod(diff, F.lit(us)), ts)


def iso_format(ts: str | Column) -> Column:
    """``datetime.isoformat()``: ``yyyy-MM-ddTHH:mm:ss`` plus ``.ffffff`` only
    when the microseconds are not zero."""
    ts = _c(ts)
    frac = F.date_format(ts, "SSSSSS")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(frac == F.lit("000000"), base).otherwise(F.concat(base, F.lit("."), frac))


def month_index(year: str | Column, month: str | Column) -> Column:
    """Months since year 0, for range predicates over ``year``/``month``
    partition columns."""
    return _c(year) * F.lit(12) + _c(month)

