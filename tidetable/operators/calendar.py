"""Regular calendars: spines, gap rows, and checks on the last period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.operators.panel import Keys, as_list, series_window

STEPS = {"month": "INTERVAL 1 MONTH", "day": "INTERVAL 1 DAY"}


def _step(unit: str) -> Column:
    return F.expr(STEPS[unit])


def _shift(value: Column, unit: str, n: int) -> Column:
    return F.add_months(value, n) if unit == "month" else F.date_add(value, n)


def spine(
    df: DataFrame,
    key: Keys = "series_key",
    time: str = "month",
    *,
    start: Column | None = None,
    end: Column | None = None,
    unit: str = "month",
) -> DataFrame:
    """Every period of each series from its first to its last one (or the given ends)."""
    keys = as_list(key)
    bounds = df.groupBy(*keys).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    lo = F.col("_lo") if start is None else start
    hi = F.col("_hi") if end is None else end
    # sequence() counts downwards when the end lies before the start
    return bounds.filter(lo <= hi).select(*keys, F.explode(F.sequence(lo, hi, _step(unit))).alias(time))


def align(
    df: DataFrame,
    key: Keys = "series_key",
    time: str = "month",
    *,
    start: Column | None = None,
    end: Column | None = None,
    unit: str = "month",
) -> DataFrame:
    """Put each series on a regular calendar; rows of missing periods hold NULL.

    Equal to a left join from :func:`spine`, but done inside the series window:
    each row is exploded up to the next one.  That needs one exchange by key,
    which lags and fills that follow use again, where the join needs three.
    """
    keys = as_list(key)
    w = series_window(keys, time)
    here = F.col(time)
    with_next = df.withColumn("_next", F.lead(time).over(w)).withColumn("_prev", F.lag(time).over(w))
    hi = here if end is None else F.coalesce(end, here)
    stop = F.greatest(here, F.coalesce(_shift(F.col("_next"), unit, -1), hi))
    begin = here
    if start is not None:
        begin = F.when(F.col("_prev").isNull(), F.least(start, here)).otherwise(here)
    slots = with_next.withColumn("_slot", F.explode(F.sequence(begin, stop, _step(unit))))
    out = slots.select(
        *[
            F.col(c)
            if c in keys
            else F.col("_slot").alias(c)
            if c == time
            else F.when(F.col("_slot") == here, F.col(c)).alias(c)
            for c in df.columns
        ]
    )
    return out if end is None else out.filter(F.col(time) <= end)


def continues(
    history: DataFrame, future: DataFrame, key: Keys = "series_key", time: str = "month"
) -> DataFrame:
    """Per series: does the first future month follow the last observed one?"""
    keys = as_list(key)
    last = history.groupBy(*keys).agg(F.max(time).alias("last_month"))
    first = future.groupBy(*keys).agg(F.min(time).alias("first_future"))
    return last.join(first, keys, "left").withColumn(
        "is_continuous",
        F.coalesce(F.col("first_future") == F.add_months("last_month", 1), F.lit(False)),
    )


def horizon_check(
    future: DataFrame, expected_first: Column, expected_last: Column, key: Keys = "series_key", time: str = "month"
) -> DataFrame:
    """Per series: first and last stored future month against the expected ones."""
    return (
        future.groupBy(*as_list(key))
        .agg(F.min(time).alias("first_month"), F.max(time).alias("last_month"))
        .withColumn(
            "is_current",
            (F.col("first_month") == expected_first) & (F.col("last_month") == expected_last),
        )
    )
