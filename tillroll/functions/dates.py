"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: dt.date | None) -> Column:
    """The reference day of a report: the given date, or today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def day_of_week(day: Column) -> Column:
    """Sunday is 0."""
    return (F.dayofweek(day) - 1).cast("bigint")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def is_active(last_date: Column, as_of: dt.date | None = None, days: int = 180) -> Column:
    """True where the last date lies within `days` of `as_of`; a missing date is not active."""
    return F.coalesce(last_date >= F.date_sub(as_of_date(as_of), days), F.lit(False))
