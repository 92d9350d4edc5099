"""Time parsing and calendar parts.  Every time is a zone-less ``timestamp_ntz``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

Moment = Column | dt.datetime | dt.date | str | None


def clock(as_of: Moment = None) -> Column:
    """The pinned moment as ``timestamp_ntz``; the wall clock where none is given."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def today(as_of: Moment = None) -> Column:
    return F.to_date(clock(as_of))


def parse_time(text: Column) -> Column:
    """Both text forms (``2024-01-31T10:15`` and ISO with ``Z``); bad text gives NULL."""
    return F.replace(text, F.lit("Z"), F.lit("")).try_cast("timestamp_ntz")


def time_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def hours_before(moment: Column, hours: int) -> Column:
    return moment - F.expr(f"INTERVAL '{hours}' HOUR")


def sunday0(day: Column) -> Column:
    """Day of week, 0 = Sunday … 6 = Saturday."""
    return F.dayofweek(day) - 1


def monday0(day: Column) -> Column:
    """Day of week, 0 = Monday … 6 = Sunday."""
    return F.weekday(day)


def is_calendar_weekend(day: Column) -> Column:
    return F.coalesce(sunday0(day).isin(0, 6), F.lit(False))


def short_day_name(day: Column) -> Column:
    return F.dayname(day)


def day_period(hour: Column) -> Column:
    out = F
    for first, last, label in fixed.DAY_PERIODS:
        out = out.when(hour.between(first, last), F.lit(label))
    return out.otherwise(F.lit(fixed.NIGHT))
