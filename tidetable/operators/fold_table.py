"""Fits of expanding folds as a table function, for models that are updated row by row.

``fit_folds`` takes a table (series_key, month, value) and the size of the first window.  Its own analysis asks Spark for
the table by series in time order, so SQL users need not say so; each row of a series behind the first window gives one
row, predicted from the rows before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

COLUMNS = ("series_key", "month", "value")


class FoldFits:
    """Regression on the value before, kept as running sums of one series."""

    def __init__(self) -> None:
        self.rows = 0
        self.before: float | None = None
        self.first: float | None = None
        self.n = self.x = self.y = self.xx = self.xy = 0.0

    @staticmethod
    def analyze(rows: AnalyzeArgument, initial_window: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument must be a table")
        fields = {f.name: f for f in rows.dataType.fields}
        missing = [c for c in COLUMNS if c not in fields]
        if missing:
            raise ValueError(f"missing columns: {missing}")
        if not initial_window.isConstantExpression or not initial_window.value or initial_window.value < 1:
            raise ValueError("initial_window must be a positive constant")
        out = [fields["series_key"], fields["month"], T.StructField("fold", T.IntegerType()), T.StructField("actual", T.DoubleType()), T.StructField("prediction", T.DoubleType())]
        return AnalyzeResult(T.StructType(out), partitionBy=[PartitioningColumn("series_key")], orderBy=[OrderingColumn("month")])

    def _predicted(self, x: float) -> float | None:
        spread = self.n * self.xx - self.x * self.x
        if self.n < 2 or spread <= 0:
            return None
        slope = (self.n * self.xy - self.x * self.y) / spread
        return self.first + (self.y - slope * self.x) / self.n + slope * (x - self.first)

    def eval(self, row: Row, initial_window: int) -> Iterator[tuple]:
        value = row["value"]
        value = None if value is None or math.isnan(value) else float(value)
        self.rows += 1
        if self.rows > initial_window:
            known = self.before is not None and self.first is not None
            yield row["series_key"], row["month"], self.rows - initial_window, value, self._predicted(self.before) if known else None
        if value is not None and self.before is not None:
            # sums are taken from the first value, which keeps them small
            x, y = self.before - self.first, value - self.first
            self.n, self.x, self.y, self.xx, self.xy = self.n + 1, self.x + x, self.y + y, self.xx + x * x, self.xy + x * y
        if self.first is None:
            self.first = value
        self.before = value


def register(spark: SparkSession) -> None:
    """Make ``fit_folds(TABLE(...), initial_window)`` known to SQL."""
    spark.udtf.register("fit_folds", F.udtf(FoldFits))


def fit_folds(df: DataFrame, initial_window: int = 60) -> DataFrame:
    """(series_key, month, fold, actual, prediction) for each row behind the first window of its series."""
    return F.udtf(FoldFits)(df.select(*COLUMNS).asTable(), F.lit(initial_window))
