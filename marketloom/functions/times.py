"""Dates, clocks and sessions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.numbers import as_column


def parse_date(value) -> Column:
    """'yyyyMMdd' (with an optional '.0') or ISO text, date or timestamp; else NULL."""
    text = F.trim(as_column(value).cast("string"))
    packed = F.regexp_extract(text, r"^(\d{8})(?:\.0)?$", 1)
    iso = F.regexp_extract(text, r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ].*)?$", 1)
    return F.coalesce(
        F.try_to_date(F.nullif(packed, F.lit("")), "yyyyMMdd"),
        F.nullif(iso, F.lit("")).try_cast("date"),
    )


def clock_seconds(value) -> Column:
    """Second of the day of 'H:MM[:SS[.fff]]', else NULL."""
    pattern = r"^(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?$"
    text = F.trim(as_column(value).cast("string"))
    hour, minute, second = (
        F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).cast("int") for group in (1, 2, 3)
    )
    second = F.coalesce(second, F.lit(0))
    valid = text.rlike(pattern) & (hour < 24) & (minute < 60) & (second < 60)
    return F.when(valid, hour * 3600 + minute * 60 + second)


def minute_of_day(ts) -> Column:
    ts = as_column(ts)
    return F.hour(ts) * 60 + F.minute(ts)


def second_of_day(ts) -> Column:
    return minute_of_day(ts) * 60 + F.second(as_column(ts))


def at_minute(date, minute) -> Column:
    """Wall-clock timestamp (no zone) of a date and a minute of the day."""
    start = as_column(date).cast("date").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), as_column(minute).cast("int"))


def unpack_date(packed) -> Column:
    """Vendor 16-bit date: year-2004 in the high part, month*100+day in the low 2048."""
    packed = as_column(packed).cast("int")
    low = packed % 2048
    year = F.floor(packed / 2048).cast("int") + 2004
    return F.try_make_timestamp_ntz(
        year, F.floor(low / 100).cast("int"), low % 100, F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")


def unpack_minutes(minutes) -> tuple[Column, Column]:
    minutes = as_column(minutes).cast("int")
    return F.floor(minutes / 60).cast("int"), minutes % 60


def in_session(ts) -> Column:
    """Strictly inside 09:30-11:30 or 13:00-15:00."""
    ts = as_column(ts)
    # Microseconds count: half a second past the opening is inside.
    second = second_of_day(ts) + F.extract(F.lit("SECOND"), ts) - F.second(ts)
    return ((second > 34_200) & (second < 41_400)) | ((second > 46_800) & (second < 54_000))


def bar_date(date=None, year="year", month="month", day="day") -> Column:
    """Date of a bar from its date column, else from year/month/day."""
    built = F.try_make_timestamp_ntz(
        as_column(year), as_column(month), as_column(day), F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")
    return built if date is None else F.coalesce(as_column(date).cast("date"), built)


def since(ts, first_date) -> Column:
    """Filter: on or after a date; rows without a valid time are dropped."""
    return F.coalesce(as_column(ts) >= F.lit(first_date).cast("date"), F.lit(False))


def within_days(ts, start, end) -> Column:
    """Filter: calendar day in [start, end); an empty or inverted range keeps nothing."""
    day = as_column(ts).cast("date")
    lower, upper = F.lit(start).cast("date"), F.lit(end).cast("date")
    return F.coalesce((lower < upper) & (day >= lower) & (day < upper), F.lit(False))
