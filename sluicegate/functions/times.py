"""Event-time parsing and clock arguments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicegate.constants import EVENT_TIME_LENGTH, EVENT_TIME_PATTERN


def parse_event_time(text: Column) -> Column:
    """Accepts a blank or a ``T`` between date and time, drops fractions; NULL when it does not parse.

    Days a month does not have and 24:00:00 are refused.
    """
    cut = F.substring(F.replace(text, F.lit("T"), F.lit(" ")), 1, EVENT_TIME_LENGTH)
    return F.when(cut.rlike(EVENT_TIME_PATTERN), cut.try_cast("timestamp"))


def as_instant(value: str | dt.datetime | Column | None) -> Column:
    """A clock argument as a column; ``None`` is the query's own clock (the trigger time in a stream)."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def plus_ms(instant: Column, ms: int | Column) -> Column:
    """The instant moved by whole milliseconds, keeping microseconds."""
    shift = (ms if isinstance(ms, Column) else F.lit(ms)).cast("bigint")
    return F.timestamp_micros(F.unix_micros(instant) + shift * F.lit(1000))
