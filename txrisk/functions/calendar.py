"""Calendar and time arithmetic on TIMESTAMP_NTZ columns.

Every function returns a Column built from Spark built-ins, so it stays inside
whole-stage code generation. NTZ values carry no zone, so results do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86400


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def weekend_flag(ts) -> Column:
    """1 on Saturday or Sunday, else 0 (F1). dayofweek: 1 = Sunday, 7 = Saturday."""
    return F.dayofweek(_c(ts)).isin(1, 7).cast("int")


def night_flag(ts) -> Column:
    """1 when the hour is at most 6, else 0 (F2). Hour 6 counts as night."""
    return (F.hour(_c(ts)) <= 6).cast("int")


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 00:00 of an NTZ timestamp, floor."""
    return F.unix_timestamp(_c(ts))


def truncate_to_second(ts) -> Column:
    """Drop the sub-second part of an NTZ timestamp, keeping the NTZ type."""
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t))


def add_seconds(origin, seconds) -> Column:
    """origin + n seconds, NTZ in and out."""
    return _c(origin) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(seconds).cast("decimal(18,6)"))


def add_days(ts, days) -> Column:
    """ts + n days (negative n subtracts), NTZ in and out (F8)."""
    n = F.lit(days) if isinstance(days, int) else _c(days)
    return _c(ts) + F.make_dt_interval(n)


def seconds_since_midnight(ts) -> Column:
    t = _c(ts)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def seconds_until_midnight(ts) -> Column:
    """Whole seconds from ts to the next midnight; exactly 0 at 00:00:00.

    A one-day difference has a seconds component of 0, so a row at midnight
    yields 0, not 86400.
    """
    return (F.lit(SECONDS_PER_DAY) - seconds_since_midnight(ts)) % SECONDS_PER_DAY


def day_string(ts) -> Column:
    """Calendar day as 'yyyy-MM-dd' (F7)."""
    return F.date_format(F.to_date(_c(ts)), "yyyy-MM-dd")


def month_string(ts) -> Column:
    """Zero-padded 'yyyy-MM' (S6 partition names)."""
    return F.date_format(_c(ts), "yyyy-MM")


def days_between(ts, origin_date: str) -> Column:
    """Whole calendar days from a fixed date to the day of ts."""
    return F.datediff(F.to_date(_c(ts)), F.to_date(F.lit(origin_date))).cast("long")
