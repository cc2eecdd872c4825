"""Months and days as DATE columns, with text only at the edges."""

from __future__ import annotations

from calendar import month_name as MONTH_NAMES
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_start(value: str | Column) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(_c(value), "MM")


def month_label(value: str | Column) -> Column:
    return F.date_format(_c(value), "yyyy-MM")


def month_name(value: str | Column) -> Column:
    return F.date_format(_c(value), "MMMM yyyy")


def month_names_between(first: date, last: date) -> list[str]:
    """``January 2016`` for every month from ``first`` to ``last``."""
    count = 12 * (last.year - first.year) + last.month - first.month + 1
    months = (date(first.year + (first.month - 1 + i) // 12, (first.month - 1 + i) % 12 + 1, 1) for i in range(count))
    return [f"{MONTH_NAMES[m.month]} {m.year}" for m in months]


def month_of_text(value: str | Column) -> Column:
    """``2016-01`` or ``2016-01-15`` as a month start; NULL when it is no month."""
    return F.to_date(F.try_to_timestamp(F.substring(_c(value), 1, 7), F.lit("yyyy-MM")))


def month_of_compact(value: str | Column) -> Column:
    """``201601`` as a month start; NULL for text such as ``202513``."""
    return F.to_date(F.try_to_timestamp(_c(value), F.lit("yyyyMM")))


def month_of_short_name(value: str | Column) -> Column:
    """``Jan-2016`` as a month start."""
    return F.to_date(F.try_to_timestamp(_c(value), F.lit("MMM-yyyy")))


def month_of_long_name(value: str | Column) -> Column:
    """``January 2016`` as a month start."""
    return F.to_date(F.try_to_timestamp(_c(value), F.lit("MMMM yyyy")))


def date_of_text(value: str | Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.to_date(F.try_to_timestamp(_c(value), F.lit(pattern)))


def month_from_parts(year: str | Column, month: str | Column) -> Column:
    """Year and month numbers, possibly as text without leading zeros."""
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1))


def add_month(value: str | Column, months: int = 1) -> Column:
    return F.add_months(_c(value), months)


def next_month(as_of: str | Column) -> Column:
    """Start of the month after ``as_of``; the clock is never read here."""
    return F.add_months(month_start(as_of), 1)


def month_number(value: str | Column) -> Column:
    """Months on one line (year * 12 + month), the order of calendar frames."""
    return F.year(_c(value)) * 12 + F.month(_c(value))


def months_apart(later: str | Column, earlier: str | Column) -> Column:
    return month_number(later) - month_number(earlier)


def day_number(value: str | Column) -> Column:
    return F.unix_date(_c(value).cast("date"))
