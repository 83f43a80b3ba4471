"""Time parts: hour, day of week (two conventions), minutes and buckets, ISO text."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dow_sunday0(d: Column) -> Column:
    """Day of week with Sunday = 0 (SQL ``%w``)."""
    return (F.dayofweek(d) - 1).cast("int")


def dow_monday0(d: Column) -> Column:
    """Day of week with Monday = 0 (``(%w + 6) % 7``, pandas ``dayofweek``)."""
    return F.weekday(d).cast("int")


def minute_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 60 + F.minute(ts)).cast("int")


def minutes_since(ts: Column, epoch: str) -> Column:
    """Whole minutes since ``epoch`` truncated toward zero (the last minute before the
    epoch becomes 0, as an int32 cast does)."""
    secs = F.timestamp_diff("SECOND", F.lit(epoch).cast("timestamp_ntz"), ts)
    return (secs / F.lit(60.0)).cast("int")


def minute_of_month(ts: Column) -> Column:
    """Whole minutes since the start of the time's own month."""
    return F.floor(F.timestamp_diff("SECOND", F.date_trunc("month", ts).cast("timestamp_ntz"), ts) / F.lit(60)).cast("int")


def bucket(t: Column, width: int) -> Column:
    return F.floor(t / F.lit(width)).cast("int")


def seconds_between(a: Column, b: Column) -> Column:
    return F.timestamp_diff("SECOND", a, b)


def iso_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def iso_ts(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
