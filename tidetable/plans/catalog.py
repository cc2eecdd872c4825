"""Registry of named queries: the Spark form, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Build
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a function under its own name; ``covers`` lists the inventory ids it exercises."""

    def register(build: Build) -> Build:
        CATALOG[build.__name__] = Query(build.__name__, tuple(covers.split()), build, sql)
        return build

    return register


def report(df: DataFrame, digits: dict[str, int] | int | None = 6) -> DataFrame:
    """Result columns in plain types: periods as text, numbers as BIGINT or rounded DOUBLE.

    ``digits=None`` leaves numbers unrounded.
    """
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd" if f.name == "day" else "yyyy-MM")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            n = digits.get(f.name, 6) if isinstance(digits, dict) else digits
            c = c.cast("double") if n is None else F.round(c.cast("double"), n)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return df.select(*columns)
