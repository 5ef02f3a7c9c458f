"""Time arithmetic on timestamps without zone."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROSECONDS_PER_DAY = 86_400_000_000


# Fixed value: a day-first date, which import and parameters accept besides ISO text.
DAY_FIRST = r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4})"


def to_datetime(value: dt.datetime | dt.date | str) -> dt.datetime:
    """Dates widen to midnight; texts are ISO or day-first, with or without a time."""
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    parts = re.match(DAY_FIRST + r"(?:\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?)?$", value.strip())
    if parts:
        day, month, year, *clock = parts.groups()
        return dt.datetime(int(year), int(month), int(day), *(int(c) for c in clock if c))
    return dt.datetime.fromisoformat(value.strip())


def moment(value: dt.datetime | dt.date | str) -> Column:
    """A literal moment without zone."""
    return F.lit(to_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    """Fractional days from start to end, by the calendar alone, in no time zone."""
    seconds = (end - start).cast("interval second").cast("decimal(18,6)").cast("double")
    # Whole microseconds: binary fractions of a second must not show in the quotient.
    return F.rint(seconds * 1_000_000) / F.lit(float(MICROSECONDS_PER_DAY))


def hour_slot(at: Column) -> Column:
    """Number of the hour a moment lies in; never falls as time goes on.

    Moments that are NULL sort before all others.
    """
    hours = (at - moment("1970-01-01 00:00:00")).cast("interval hour").cast("long")
    return F.coalesce(hours, F.lit(-(10**15)))
