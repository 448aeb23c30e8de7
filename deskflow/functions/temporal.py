"""Time expressions on wall-clock (``timestamp_ntz``) columns.

All helpers are built from date parts so that they do not depend on the
session time zone: warehouse times are wall-clock values.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from deskflow.functions.util import col


def days_crossed(start, end) -> Column:
    """Number of day boundaries between two times (SQL ``DATEDIFF(DAY, a, b)``)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def hours_crossed(start, end) -> Column:
    """Number of hour boundaries crossed (``DATEDIFF(HOUR, a, b)``), not
    elapsed hours: 00:59:30 -> 01:01:00 is 1."""
    return days_crossed(start, end) * 24 + F.hour(col(end)) - F.hour(col(start))


def minutes_crossed(start, end) -> Column:
    """Number of minute boundaries crossed (``DATEDIFF(MINUTE, a, b)``)."""
    return hours_crossed(start, end) * 60 + F.minute(col(end)) - F.minute(col(start))


def _micros_of_day(ts) -> Column:
    c = col(ts)
    seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return seconds.cast("long") * 1_000_000 + F.date_format(c, "SSSSSS").cast("long")


def elapsed_micros(start, end) -> Column:
    """Wall-clock microseconds from ``start`` to ``end`` (no time zone, so no
    daylight-saving jumps)."""
    return (days_crossed(start, end).cast("long") * 86_400_000_000
            + _micros_of_day(end) - _micros_of_day(start))


def elapsed_hours(start, end) -> Column:
    """Whole elapsed hours, truncated toward zero (for contrast with
    ``hours_crossed``)."""
    us, hour = elapsed_micros(start, end), F.lit(3_600_000_000)
    return F.round((us - us % hour) / hour).cast("long")


def add_minutes(ts, minutes) -> Column:
    """``ts + minutes`` for an integer column or literal."""
    m = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), m.cast("long"))


def add_hours(ts, hours) -> Column:
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return col(ts) + F.make_dt_interval(F.lit(0), h.cast("int"))


def add_days(ts, days) -> Column:
    d = days if isinstance(days, Column) else F.lit(days)
    return col(ts) + F.make_dt_interval(d.cast("int"))


def hour_start(ts) -> Column:
    """Truncate to the hour, staying ``timestamp_ntz``."""
    c = col(ts)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def day_start(ts) -> Column:
    return F.to_date(col(ts))


def round_to_millis(ts) -> Column:
    """Round half up to milliseconds, as a DATETIME2(3) column stores times."""
    c = col(ts)
    rest = F.date_format(c, "SSSSSS").cast("int") % 1000
    shift_us = F.when(rest >= 500, 1000 - rest).otherwise(-rest)
    return c + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (shift_us / 1_000_000).cast("decimal(8,6)"))


def parse_iso(text) -> Column:
    """Parse ``yyyy-MM-dd[ HH:mm[:ss[.f]]]`` to ``timestamp_ntz``; bad input -> null."""
    return col(text).try_cast("timestamp_ntz")


DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}:\d{2}(?::\d{2})?)$"


def parse_dayfirst(text) -> Column:
    """Parse ``d/M/yyyy H:mm[:ss]`` (day first) to ``timestamp_ntz``; bad or
    impossible dates -> null; ISO text is accepted as well.  One pattern
    rewrite to ``yyyy-M-d H:mm`` and one cast (single-digit fields are valid
    in Spark's timestamp text form), so the text is scanned once."""
    return F.regexp_replace(F.trim(col(text)), DAY_FIRST, "$3-$2-$1 $4").try_cast("timestamp_ntz")


def calendar_parts(ts) -> dict[str, Column]:
    """Calendar columns of a time: year, month, quarter, day name, hour, year-month."""
    c = col(ts)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "quarter": F.quarter(c),
        "day_of_week": F.date_format(c, "EEEE"),
        "hour_of_day": F.hour(c),
        "year_month": F.date_format(c, "yyyy-MM"),
    }

