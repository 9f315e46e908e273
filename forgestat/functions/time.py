"""Time arithmetic with the reference's boundary semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trunc_ntz(unit: str, ts: str | Column) -> Column:
    """``date_trunc`` that stays ``timestamp_ntz``."""
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def hour_boundaries(start: str | Column, end: str | Column) -> Column:
    """Number of hour boundaries crossed from start to end.

    10:59 -> 11:01 is 1, 11:01 -> 10:59 is -1; NULL if either side is NULL.
    """
    return F.timestamp_diff("HOUR", trunc_ntz("hour", start), trunc_ntz("hour", end)).cast("bigint")


def day_boundaries(start: str | Column, end: str | Column) -> Column:
    """Midnights crossed from start to end, BIGINT."""
    return F.datediff(_c(end).cast("date"), _c(start).cast("date")).cast("bigint")


def day_of_week_sun0(d: str | Column) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(_c(d)) - 1).cast("int")


def to_date_key(d: str | Column) -> Column:
    """yyyyMMdd as INT."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")
