"""Calendar expressions. All of them work on dates, so no session time zone is involved."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, TimestampNTZType


def date_key(day: Column) -> Column:
    """Integer key ``yyyyMMdd``."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_of_week(day: Column, iso: bool = False) -> Column:
    """1 = Sunday … 7 = Saturday, or 1 = Monday … 7 = Sunday with ``iso``."""
    return (F.weekday(day) + 1) if iso else F.dayofweek(day)


def day_name(day: Column) -> Column:
    """Three-letter English day name."""
    return F.dayname(day)


def instant(value: datetime | str, as_type: DataType | None = None) -> Column:
    """A timestamp literal of the given type, so that filters on it reach the scan.

    The value passes through its text form: a Python ``datetime`` literal would take
    on the session time zone, which a timestamp without time zone must not do.
    """
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast(as_type or TimestampNTZType())
