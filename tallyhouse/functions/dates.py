"""Dates, times and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _drop_1900(col: Column) -> Column:
    return F.when(F.year(col) != 1900, col)


def parse_timestamp(col: Column, fmt: str | None = None, keep_1900: bool = False) -> Column:
    """Text to timestamp; unreadable text and the year-1900 filler become NULL."""
    parsed = F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)
    return parsed if keep_1900 else _drop_1900(parsed)


def parse_date(col: Column, fmt: str | None = None, keep_1900: bool = False) -> Column:
    return F.to_date(parse_timestamp(col, fmt, keep_1900))


def utc_to_local(ts: Column, zone: Column) -> Column:
    """Shift a UTC instant to the wall clock of a zone that may differ per row."""
    return F.from_utc_timestamp(ts, zone)


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def days_between(start: Column, end: Column) -> Column:
    """Fractional days."""
    return seconds_between(start, end) / F.lit(86_400.0)


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week."""
    return F.date_trunc("week", ts)


def floor_to(ts: Column, minutes: int) -> Column:
    """Timestamp floored to a multiple of ``minutes`` since the epoch."""
    step = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / step) * step)


def age_on(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365.25 days on a date, never above 100.

    A missing birthday also gives 100: the cap ignores NULL.
    """
    return F.least(F.floor(F.datediff(as_of, birthday) / 365.25), F.lit(100)).cast("int")


def clamp_end(received: Column, complete: Column, applies: Column,
              low_minutes: int = 20, high_minutes: int = 180) -> Column:
    """Limit a delivery's end to a window after it was received.

    Durations above the maximum are cut to it, those below the minimum raised.
    """
    took = minutes_between(received, complete)
    return (F.when(applies & (took > high_minutes),
                   F.timestamp_micros(F.unix_micros(received) + high_minutes * 60_000_000))
            .when(applies & (took < low_minutes),
                  F.timestamp_micros(F.unix_micros(received) + low_minutes * 60_000_000))
            .otherwise(complete))


def distinct_days(day: Column) -> Column:
    """Number of different days of a group, an aggregate: a bitmap of one bit per day, NULL not counted.

    Bitmaps merge before the shuffle and need no second grouping, as a distinct count does. Days must lie within 32,768 days (89 years) of one another.
    """
    return F.bitmap_count(F.bitmap_construct_agg(F.pmod(F.unix_date(day), F.lit(32768)).cast("long")))
