"""Scalar helpers: null-safe comparison, names, card numbers, durations, calendar fields."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def changed(left: str, right: str, cols: Iterable[str]) -> Column:
    """True when any of ``cols`` differs between two aliases; NULL against a value is a change."""
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def full_name(*parts: str | Column) -> Column:
    """Name parts joined by one blank; missing parts are skipped."""
    return F.concat_ws(" ", *[as_col(p) for p in parts])


def strip_blanks(c: str | Column) -> Column:
    """Card and phone numbers are compared without blanks."""
    return F.translate(as_col(c), " ", "")


def decimal_comma(c: str | Column, to: str = "decimal(10,2)") -> Column:
    """Text with a decimal comma as a number; unreadable text becomes NULL."""
    return F.translate(F.trim(as_col(c)), ",", ".").try_cast(to)


def elapsed_us(start: str | Column, end: str | Column) -> Column:
    """Microseconds from ``start`` to ``end`` over days, not the fields of an interval."""
    s, e = as_col(start).cast("timestamp"), as_col(end).cast("timestamp")
    return F.unix_micros(e) - F.unix_micros(s)


def iso_year(c: str | Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), as_col(c))


def iso_week(c: str | Column) -> Column:
    return F.weekofyear(as_col(c))


def timestamp_parts(c: str | Column) -> dict[str, Column]:
    """Year, month, day, wall-clock time and date of a timestamp."""
    t = as_col(c)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "time": F.date_format(t, "HH:mm:ss"),
        "date": F.to_date(t),
    }


def local_time(utc: str | Column, zone: str | Column) -> Column:
    """Wall-clock time in ``zone`` of a UTC timestamp, without a zone of its own."""
    return F.from_utc_timestamp(as_col(utc).cast("timestamp"), as_col(zone)).cast("timestamp_ntz")


def once(value: Column) -> Column:
    """A costly value as a generated column: later filters, joins and generators cannot work it out a second time."""
    return F.explode(F.array(value))
