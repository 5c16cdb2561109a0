"""Wall-clock expressions. Everything here is zone-free (DATE and TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm_number(text: Column) -> Column:
    """Clock text such as '0005' or '1932.0' to a smallint; anything else becomes NULL."""
    return F.rint(text.try_cast("double")).cast("smallint")


def hhmm_hour(hhmm: Column) -> Column:
    """Hour of an hhmm number; 2400 and beyond is hour 0 of the same day."""
    return F.when(hhmm >= 2400, 0).otherwise(F.floor(hhmm / 100).cast("int"))


def hhmm_minute(hhmm: Column) -> Column:
    """Minute of an hhmm number; 2400 and beyond is minute 0."""
    return F.when(hhmm >= 2400, 0).otherwise((hhmm % 100).cast("int"))


def wall_clock(day: Column, hour: Column, minute: Column) -> Column:
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), hour, minute, F.lit(0))


def hour_bucket(ts: Column) -> Column:
    """Start of the hour of a TIMESTAMP_NTZ.

    ``date_trunc`` answers with a zoned timestamp, which moves wall-clock hours
    that a daylight-saving switch skips.
    """
    return wall_clock(ts.cast("date"), F.hour(ts), F.lit(0))


def date_key(day: Column) -> Column:
    """yyyymmdd as an int."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_start(day: Column) -> Column:
    """Grouping key of a month: a date is cheaper to hash and shuffle than its label."""
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
