"""Sorting at the edge, top-k, and the choice of the forecast to show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.functions import numeric
from tidetable.operators.panel import Keys, as_list


def top_k(df: DataFrame, k: int, by: str, ties: Keys) -> DataFrame:
    """The ``k`` largest rows of the whole table (a top-k per partition, then a merge)."""
    return df.orderBy(F.col(by).desc_nulls_last(), *as_list(ties)).limit(k)


def top_k_per_group(df: DataFrame, k: int, by: str, group: Keys, ties: Keys) -> DataFrame:
    """The ``k`` largest rows of each group; Spark cuts each group before the shuffle."""
    w = Window.partitionBy(*as_list(group)).orderBy(F.col(by).desc_nulls_last(), *as_list(ties))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def preview(df: DataFrame, n: int = 5, order: Keys = ()) -> DataFrame:
    return df.orderBy(*as_list(order)).limit(n) if as_list(order) else df.limit(n)


def display_forecast(
    points: DataFrame,
    next_month: Column,
    key: Keys = "series_key",
    time: str = "month",
    *,
    price: str = "price",
    forecast: str = "forecast",
) -> DataFrame:
    """Per series: the forecast of the next month, else the first later, else the last one,
    with the point before it and the percent change between the two.

    One group-by; the points of a series are bounded by the calendar, so the
    choice is made on their array.
    """
    t, is_forecast = F.col(time), F.col(forecast)
    grouped = points.groupBy(*as_list(key)).agg(
        F.coalesce(
            F.max(F.when(is_forecast & (t == next_month), t)),
            F.min(F.when(is_forecast & (t > next_month), t)),
            F.max(F.when(is_forecast, t)),
        ).alias("prediction_month"),
        F.array_sort(F.collect_list(F.struct(t.alias("t"), is_forecast.alias("f"), F.col(price).alias("p")))).alias("_points"),
    )
    chosen = F.col("prediction_month")
    shown = F.filter("_points", lambda p: p["f"] & (p["t"] == chosen))
    before = F.filter("_points", lambda p: p["t"] < chosen)
    return (
        grouped.withColumns({"forecast_price": F.get(shown, F.lit(0))["p"], "previous_price": F.try_element_at(before, F.lit(-1))["p"]})
        .drop("_points")
        .withColumn("change_pct", F.coalesce(numeric.pct_change("forecast_price", "previous_price"), F.lit(0.0)))
    )


def first_future_columns(time: str = "month", *, price: str = "price", forecast: str = "forecast") -> dict[str, Column]:
    """Aggregates that :func:`first_future` finishes."""
    t, is_forecast = F.col(time), F.col(forecast)
    observed = F.when(~is_forecast, t)
    return {
        "_last": F.max(observed),
        "_last_price": F.max_by(F.col(price), observed),
        "_ahead": F.array_sort(F.collect_list(F.when(is_forecast, F.struct(t.alias("t"), F.col(price).alias("p"))))),
    }


def first_future(grouped: DataFrame) -> DataFrame:
    """First forecast after the latest actual and its percent change; all NULL when there is none."""
    later = F.filter("_ahead", lambda p: p["t"] > F.col("_last"))
    return (
        grouped.withColumn("_first", F.get(later, F.lit(0)))
        .withColumns({"prediction_month": F.col("_first.t"), "forecast_price": F.round("_first.p", 2)})
        .withColumn("change_pct", numeric.pct_change("forecast_price", "_last_price"))
        .drop("_first", "_last", "_last_price", "_ahead")
    )


def change_of_first_future(points: DataFrame, key: Keys = "series_key", time: str = "month", *, price: str = "price", forecast: str = "forecast") -> DataFrame:
    """Per series: month, price and percent change of the first forecast beyond the latest actual."""
    aggs = first_future_columns(time, price=price, forecast=forecast)
    return first_future(points.groupBy(*as_list(key)).agg(*[a.alias(n) for n, a in aggs.items()]))
