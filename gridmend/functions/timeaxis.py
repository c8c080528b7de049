"""Calendar arithmetic as column expressions.

A *step* numbers the days of a time axis without gaps: days since 1970-01-01 on the standard calendar,
``year * 365 + day_of_year - 1`` on the noleap calendar (no 29 February), ``year * 360 + ...`` on the
360-day calendar. Neighbouring days always differ by one step.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STANDARD, NOLEAP, DAY360 = "standard", "noleap", "360_day"


def is_leap_year(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def is_leap_day(date: Column) -> Column:
    return (F.month(date) == 2) & (F.dayofmonth(date) == 29)


def noleap_doy(date: Column) -> Column:
    """Day of year 1..365 of a date whose axis has no 29 February."""
    shift = F.when(is_leap_year(F.year(date)) & (F.dayofyear(date) > 59), 1).otherwise(0)
    return F.dayofyear(date) - shift


def doy(date: Column, calendar: str = NOLEAP) -> Column:
    _known(calendar)
    return noleap_doy(date) if calendar == NOLEAP else F.dayofyear(date)


def step(date: Column, calendar: str = NOLEAP) -> Column:
    """Gap-free day number of ``date``."""
    _known(calendar)
    if calendar == NOLEAP:
        return F.year(date) * 365 + noleap_doy(date) - 1
    return F.unix_date(date)


def doy_of_step(number: Column, calendar: str = NOLEAP) -> Column:
    _known(calendar)
    if calendar == NOLEAP:
        return (F.pmod(number, F.lit(365)) + 1).cast("int")
    return F.dayofyear(F.date_from_unix_date(number))


def date_of_step(number: Column, calendar: str = NOLEAP) -> Column:
    _known(calendar)
    if calendar == STANDARD:
        return F.date_from_unix_date(number)
    return noleap_date(F.floor(number / 365).cast("int"), F.pmod(number, F.lit(365)).cast("int") + 1)


def noleap_date(year: Column, day: Column) -> Column:
    """Date of day ``day`` (1..365) in a year that skips 29 February."""
    skipped = F.when(is_leap_year(year) & (day >= 60), 1).otherwise(0)
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (day - 1 + skipped).cast("int"))


def step_360(year: Column, month: Column, day: Column) -> Column:
    """Gap-free day number on the 360-day calendar (which has a 30 February)."""
    return year * 360 + (month - 1) * 30 + day - 1


def time_axis(cube: DataFrame, time_range: tuple | DataFrame | None = None) -> tuple | DataFrame:
    """Ends of a cube's time axis: a pair of dates, or a one-row table with the dates ``first`` and ``last``.

    ``time_range`` states them in either form; without it they are looked up in the ``date`` column.
    """
    if time_range is not None:
        return time_range
    return cube.agg(F.min("date").alias("first"), F.max("date").alias("last"))


def clip_axis(axis: tuple | DataFrame, first: dt.date, last: dt.date) -> tuple | DataFrame:
    """The part of a time axis between two dates."""
    if isinstance(axis, DataFrame):
        return axis.select(F.greatest("first", F.lit(first)).alias("first"), F.least("last", F.lit(last)).alias("last"))
    return max(as_date(axis[0]), first), min(as_date(axis[1]), last)


def axis_value(axis: tuple | DataFrame, calendar: str, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine`` of the first and last step of an axis: a literal, or one scalar subquery."""
    if isinstance(axis, DataFrame):
        ends = combine(step(F.col("first"), calendar), step(F.col("last"), calendar))
        return axis.select(ends.alias("value")).scalar()
    return combine(*[step(F.lit(as_date(d)), calendar) for d in axis])


def as_date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def label_bounds(first, last) -> tuple:
    """Widen partial date labels (``"1950"``, ``"1950-06"``) to the whole period; other labels pass through."""
    return _period(first)[0], _period(last)[1]


def _period(label):
    if not isinstance(label, str):
        return label, label
    parts = label.split("-")
    if len(parts) == 1 and len(label) == 4 and label.isdigit():
        return dt.date(int(label), 1, 1), dt.date(int(label), 12, 31)
    if len(parts) == 2 and len(parts[0]) == 4:
        year, month = int(parts[0]), int(parts[1])
        after = dt.date(year + month // 12, month % 12 + 1, 1)
        return dt.date(year, month, 1), after - dt.timedelta(days=1)
    if len(parts) == 3 and len(parts[0]) == 4:
        return dt.date.fromisoformat(label), dt.date.fromisoformat(label)
    return label, label


def _known(calendar: str) -> None:
    if calendar not in (NOLEAP, STANDARD):
        raise ValueError(f"dates live on the {NOLEAP!r} or {STANDARD!r} calendar, got {calendar!r}")
