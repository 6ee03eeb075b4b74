"""Calendar keys, durations and service-level flags on wall-clock timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """YYYYMMDD as an integer."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_key(ts: Column) -> Column:
    """HHMM as an integer."""
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    return (end - start).cast("interval second").cast("decimal(20,6)")


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes to two decimals, negative if ``end`` is earlier."""
    return F.round(seconds_between(start, end) / 60, 2).cast("decimal(18,2)")


def is_breached(actual: Column, due: Column) -> Column:
    """Late, or not known to be in time."""
    return F.coalesce(actual > due, F.lit(True))


def is_met(actual: Column, due: Column) -> Column:
    """In time; the complement of :func:`is_breached`."""
    return F.coalesce(actual <= due, F.lit(False))


def shift_of_hour(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 13), "morning").when(hour.between(14, 21), "evening").otherwise("night")
    )


def older_than(ts: Column, as_of: Column, hours: int) -> Column:
    return ts < as_of - F.make_dt_interval(hours=F.lit(hours))
