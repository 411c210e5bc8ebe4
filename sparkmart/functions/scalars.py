"""Scalar column functions: ISO dates, composite and date keys, calendar flags, safe casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the one date shape documents use, with optional fractions of a second
ISO_INSTANT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?Z$"


def iso_to_timestamp(text: Column) -> Column:
    """Instant of an ISO string; NULL for every other shape and for impossible dates.

    The plain cast parses this shape in generated code, without a formatter object per row;
    the pattern keeps out the shorter forms that the cast would also take.
    """
    return F.when(text.rlike(ISO_INSTANT), text).try_cast("timestamp")


def iso_to_date(text: Column) -> Column:
    """Calendar day written in an ISO string, whatever the session time zone."""
    return F.when(iso_to_timestamp(text).isNotNull(), F.left(text, F.lit(10)).try_cast("date"))


def iso_to_epoch(text: Column) -> Column:
    """Whole seconds since 1970-01-01 UTC."""
    return F.unix_seconds(iso_to_timestamp(text))


def composite_key(number: Column, epoch: Column) -> Column:
    """The two numbers written one after the other, as a decimal that holds any int and bigint.

    NULL when a part is missing or negative.
    """
    text = F.concat(number.cast("string"), epoch.cast("string"))
    return F.when((number >= 0) & (epoch >= 0), text.cast("decimal(38,0)"))


def date_key(day: Column) -> Column:
    """A date as the integer ``yyyymmdd``."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def is_weekday(day: Column) -> Column:
    """1 from Monday to Friday, else 0."""
    return F.when(F.weekday(day) >= 5, 0).otherwise(1)


def is_leapyear(day: Column) -> Column:
    """1 in Gregorian leap years, else 0."""
    year = F.year(day)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    return F.when(leap, 1).otherwise(0)


def to_bool(text: Column) -> Column:
    """``true``/``false`` strings as boolean, anything else as NULL."""
    return text.try_cast("boolean")
