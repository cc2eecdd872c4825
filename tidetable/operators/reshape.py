"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.operators.panel import Keys, as_list


def pivot(
    df: DataFrame, index: Keys, columns: str, values: Sequence[str], measure: str, how: str = "first", other: str | None = None
) -> DataFrame:
    """One column per listed value of ``columns``, as conditional aggregates in one group-by.

    The list is given so that no extra job looks for it.  Rows of other values go to the column ``other``, or fail the
    job if there is none; nothing is dropped.
    """
    agg = {"first": lambda c: F.first(c, ignorenulls=True), "sum": F.sum, "mean": F.avg}[how]
    listed = F.coalesce(F.col(columns).isin(*values), F.lit(False))
    cells = [agg(F.when(F.col(columns) == v, F.col(measure))).alias(v) for v in values]
    if other:
        return df.groupBy(*as_list(index)).agg(*cells, agg(F.when(~listed, F.col(measure))).alias(other))
    stray = F.min(F.when(~listed, F.coalesce(F.col(columns).cast("string"), F.lit("NULL")))).alias("_stray")
    out = df.groupBy(*as_list(index)).agg(*cells, stray)
    first = values[0]
    fail = F.raise_error(F.concat(F.lit(f"{columns} has a value that is not listed: "), "_stray")).cast(out.schema[first].dataType)
    return out.withColumn(first, F.when(F.col("_stray").isNull(), F.col(first)).otherwise(fail)).drop("_stray")


def unpivot(
    df: DataFrame, index: Keys, columns: Sequence[str], name: str = "variable", value: str = "value"
) -> DataFrame:
    return df.unpivot(as_list(index), list(columns), name, value)


def wide_months_to_long(
    df: DataFrame, index: Keys, month_of: callable, time: str = "month", value: str = "value"
) -> DataFrame:
    """Columns named after months become rows; ``month_of`` turns a column name into a DATE."""
    index = as_list(index)
    months = [c for c in df.columns if c not in index]
    return unpivot(df, index, months, "_label", value).select(
        *index, month_of(F.col("_label")).alias(time), value
    )


def recode(column: str | Column, labels: dict[str, str], default: str | None = None) -> Column:
    """Replace listed values; others stay as they are, or become ``default``."""
    c = F.col(column) if isinstance(column, str) else column
    chain = None
    for old, new in labels.items():
        chain = F.when(c == old, F.lit(new)) if chain is None else chain.when(c == old, F.lit(new))
    return chain.otherwise(c if default is None else F.lit(default))
