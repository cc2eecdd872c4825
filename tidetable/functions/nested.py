"""Nested documents: points inside payloads, and documents built from rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def points_or_empty(points: str | Column, element: str) -> Column:
    """The array, or an empty one of the same ``element`` type when it is absent."""
    return F.coalesce(_c(points), F.array().cast(f"array<{element}>"))


def points_of_period(points: str | Column, period: str | Column, field: str = "refPer") -> Column:
    """Only the points whose ``field`` equals ``period``."""
    return F.filter(_c(points), lambda p: p[field] == _c(period))


def periods_of(points: str | Column, field: str = "refPer") -> Column:
    """Sorted distinct periods of an array of points."""
    return F.array_sort(F.array_distinct(F.transform(_c(points), lambda p: p[field])))


def sorted_points(*fields: str | Column) -> Column:
    """Aggregate: one array of structs in the order of the first field.

    A series holds one point per period, so the array is bounded by the calendar.
    """
    return F.array_sort(F.collect_list(F.struct(*[_c(f) for f in fields])))


def only_if(condition: str | Column, value: str | Column) -> Column:
    """The value where the condition holds; ``to_json`` leaves the NULL field out."""
    return F.when(_c(condition), _c(value))
