"""Nominal forecasts, publication documents and display summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.functions import dates, nested, numeric, text
from tidetable.operators import joins, panel, ranking
from tidetable.operators.panel import Keys, as_list


def nominal_forecast(predictions: DataFrame, index: DataFrame, base: Column, *, order: Keys = "load_seq") -> DataFrame:
    """Forecasts back at the price level of their month.

    The last arrival per series and month counts, incomplete rows fall out, and
    each month takes the latest index at or before it; a month before the first
    index value fails the job.
    """
    usable = predictions.na.drop(subset=["month", "prediction", "lower_bound", "upper_bound"])
    latest = panel.keep_last(usable, ["series_key", "month"], order)
    index = joins.with_base(index.filter(F.col("cpi").isNotNull()).select("month", "cpi"), "cpi", base, name="base_cpi")
    pair = index.select("month", F.struct("cpi", "base_cpi").alias("index"))
    dated = joins.as_of_calendar(latest, pair, "index")
    based = joins.require_matched(dated, "index", "no index at or before a forecast month").select(
        *latest.columns, "index.cpi", "index.base_cpi"
    )
    return based.select(
        "series_key",
        "month",
        numeric.reinflate("prediction", "cpi", "base_cpi").alias("price"),
        numeric.reinflate("lower_bound", "cpi", "base_cpi").alias("lower_bound"),
        numeric.reinflate("upper_bound", "cpi", "base_cpi").alias("upper_bound"),
        F.lit(True).alias("forecast"),
    )


def merged_series(actual: DataFrame, forecast: DataFrame, *, start: Column, order: Keys = "load_seq") -> DataFrame:
    """Actuals from ``start`` on, and forecasts only for months without an actual."""
    observed = panel.keep_last(actual.na.drop(subset=["month", "price"]), ["series_key", "month"], order)
    observed = observed.filter(F.col("month") >= start).select(
        "series_key", "month", "price", F.lit(False).alias("forecast")
    )
    return joins.override(observed, forecast, ["series_key", "month"])


def documents(merged: DataFrame, unit: Column | str = "kg") -> DataFrame:
    """One row per series: header fields and the array of points; bounds only on forecasts.

    Header and points come from one group-by, so the merged table is read once.
    """
    header = ranking.first_future_columns()
    points = nested.sorted_points(
        dates.month_label("month").alias("date"),
        F.round("price", 2).alias("price"),
        "forecast",
        nested.only_if("forecast", F.round("lower_bound", 2)).alias("lower_bound"),
        nested.only_if("forecast", F.round("upper_bound", 2)).alias("upper_bound"),
    )
    grouped = merged.groupBy("series_key").agg(points.alias("series"), *[a.alias(n) for n, a in header.items()])
    found = ranking.first_future(grouped)
    return found.select(
        F.col("series_key").alias("product"),
        (F.lit(unit) if isinstance(unit, str) else unit).alias("unit_label"),
        dates.month_name("prediction_month").alias("prediction_month"),
        "forecast_price",
        "change_pct",
        "series",
    )


def as_json(documents: DataFrame) -> DataFrame:
    """(product, document); NULL fields are left out of the text."""
    return documents.select("product", F.to_json(F.struct(*documents.columns)).alias("document"))


def display_summary(
    merged: DataFrame, next_month: Column, *, unit: Column | str = "kg", stored: DataFrame | None = None, per_unit: Column | None = None
) -> DataFrame:
    """Forecast to show, its month name, unit caption and percent change per series.

    A series without a forecast shows what its ``stored`` header says (series_key,
    unit_label, prediction_month, forecast_price, change_pct), one row for each
    series, and without that no prediction.  ``per_unit`` marks series that are
    sold by the piece.
    """
    shown = ranking.display_forecast(merged, next_month)
    header = ("unit_label", "prediction_month", "forecast_price", "change_pct")
    if stored is None:
        nothing = {f"_{c}": F.lit(None).cast("double" if c in header[2:] else "string") for c in header}
        shown = shown.withColumns(nothing)
    else:
        shown = shown.join(stored.select("series_key", *[F.col(c).alias(f"_{c}") for c in header]), "series_key", "left")
    chosen = F.col("prediction_month").isNotNull()
    own_unit = F.coalesce("_unit_label", F.lit(unit) if isinstance(unit, str) else unit)
    return shown.select(
        "series_key",
        text.unit_label(own_unit, per_unit).alias("unit_label"),
        F.when(chosen, dates.month_name("prediction_month")).otherwise(F.coalesce("_prediction_month", F.lit("No prediction yet"))).alias("prediction_month"),
        F.when(chosen, F.col("forecast_price")).otherwise(F.coalesce("_forecast_price", F.lit(0.0))).alias("forecast_price"),
        F.when(chosen, F.col("change_pct")).otherwise(F.coalesce("_change_pct", F.lit(0.0))).alias("change_pct"),
    )


def phases(merged: DataFrame, current_month: Column, *, forecast: str = "forecast") -> DataFrame:
    """historical, delayed (a forecast month that has already come) or forecast."""
    phase = (
        F.when(~F.col(forecast), "historical")
        .when(F.col("month") <= current_month, "delayed")
        .otherwise("forecast")
    )
    return merged.withColumn("phase", phase)


def chart_range(merged: DataFrame, key: Keys = "series_key") -> DataFrame:
    """Padded lower and upper chart limits of each series' prices."""
    keys = as_list(key)
    return (
        merged.groupBy(*keys)
        .agg(F.min("price").alias("low"), F.max("price").alias("high"))
        .withColumn("_pad", numeric.padding("low", "high"))
        .select(*keys, (F.col("low") - F.col("_pad")).alias("chart_low"), (F.col("high") + F.col("_pad")).alias("chart_high"))
    )
