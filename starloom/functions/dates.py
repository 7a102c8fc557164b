"""Calendar parts and date arithmetic with the warehouse's conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_year(d: Column) -> Column:
    """Week number where week 1 holds 1 January and weeks start on Sunday (not the ISO week)."""
    first_weekday = F.dayofweek(F.trunc(d, "year"))
    return F.floor((F.dayofyear(d) + first_weekday - 2) / 7).cast("int") + 1


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def minutes_before(ts: Column, minutes: int) -> Column:
    return ts - F.make_dt_interval(mins=F.lit(minutes))


def window_start(ts: Column, seconds: int = 900) -> Column:
    """Start of the tumbling interval a moment falls into, as epoch seconds."""
    epoch = F.unix_seconds(ts.cast("timestamp"))
    return epoch - F.pmod(epoch, F.lit(seconds))
