"""Nested JSON scans; the nested shape is opened with explode, never in Python."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable import schemas
from tidetable.functions import dates, nested, numeric

Paths = str | Sequence[str]


def scan_json(spark: SparkSession, paths: Paths, schema: str, *, multi_line: bool = True) -> DataFrame:
    """JSON documents or arrays of records, several files at once.

    ``multi_line`` suits files that hold one array; line-delimited files should
    turn it off, so that large files are split.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(paths if isinstance(paths, str) else list(paths))


def vector_points(payload: DataFrame, *, ok: str = "SUCCESS") -> DataFrame:
    """(vector_id, month, value) of every successful document; failed ones are dropped before the explode."""
    points = nested.points_or_empty("object.vectorDataPoint", schemas.VECTOR_POINT)
    return (
        payload.filter(F.col("status") == ok)
        .select(F.col("object.vectorId").alias("vector_id"), F.explode(points).alias("p"))
        .select("vector_id", dates.month_of_text("p.refPer").alias("month"), numeric.to_number("p.value").alias("value"))
    )


def coded_series(payload: DataFrame, code: str, name: str) -> DataFrame:
    """(month, name) of one coded series; observations without the code are skipped."""
    return (
        payload.select(F.explode("observations").alias("o"))
        .select(dates.month_of_text("o.d").alias("month"), numeric.to_number(F.col(f"o.{code}.v")).alias(name))
        .filter(F.col(name).isNotNull())
    )


def grouped_series(payload: DataFrame, names: dict[str, str]) -> DataFrame:
    """(month, one column per code), leaving out months where every code is missing."""
    rows = payload.select(F.explode("observations").alias("o")).select(
        dates.month_of_text("o.d").alias("month"),
        *[numeric.to_number(F.col(f"o.{code}.v")).alias(name) for code, name in names.items()],
    )
    present = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names.values()])
    return rows.filter(present)


def response_data(payload: DataFrame) -> DataFrame:
    """(month, value) of ``response.data[]``."""
    return payload.select(F.explode("response.data").alias("d")).select(
        dates.month_of_text("d.period").alias("month"), numeric.to_number("d.value").alias("value")
    )
